"""The whole matcher of points with sequences: routes, passage preference, ties, doubts; and one sequence per preparation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import texts
from tidemark.session import settled

# What is said about a match.
EPI_NAME_DIFFERS, EPI_NOT_IN_STORE, SEVERAL = "match.epi-name-differs", "match.epi-not-in-store", "match.several-accessions"
EGG_WITHOUT_EGG, CELL_FROM_ORIGINAL, CELL_FROM_EGG = "match.egg-antigen-no-egg-sequence", "match.cell-antigen-original-sequence", "match.cell-antigen-egg-sequence"
IDENTICAL, AMBIGUOUS, OWN_LAB, PASSAGE_EXACT = "match.identical-duplicates", "match.ambiguous", "match.own-lab", "match.passage-exact"
LAB_NUMBER, COLLISION, EQUIVALENT, SPACING = "match.lab-number", "match.lab-number-collision", "match.location-equivalent", "match.name-spacing"
REASSORTANT, NONE = "match.reassortant", "match.none"
#: Flags that make a match doubtful, and those of them that colouring still takes.
DOUBTFUL = (EPI_NAME_DIFFERS, SEVERAL, EGG_WITHOUT_EGG, CELL_FROM_EGG, AMBIGUOUS, REASSORTANT)
USABLE = (EGG_WITHOUT_EGG, CELL_FROM_EGG, REASSORTANT, EPI_NAME_DIFFERS)


def preference(wanted: Column, classes: Column) -> Column:
    """(use, flag): the passage class among `classes` that a point of class `wanted` takes; `any` takes all."""
    has = lambda c: F.array_contains(classes, c)
    answer = lambda use, flag=None: F.struct(F.lit(use).alias("use"), F.lit(flag).cast("string").alias("flag"))
    egg = F.when(has("egg"), answer("egg")).when(has("original"), answer("original", EGG_WITHOUT_EGG)).when(has("cell"), answer("cell", EGG_WITHOUT_EGG)).otherwise(answer("any", EGG_WITHOUT_EGG))
    cell = F.when(has("cell"), answer("cell")).when(has("original"), answer("original", CELL_FROM_ORIGINAL)).when(has("egg"), answer("any", CELL_FROM_EGG)).otherwise(answer("any"))
    other = F.when(F.array_contains(classes, wanted), F.struct(wanted.alias("use"), F.lit(None).cast("string").alias("flag"))).otherwise(answer("any"))
    return F.when(wanted == "egg", egg).when(wanted == "cell", cell).otherwise(other)


def _flags(*flags: Column) -> Column:
    return F.array_compact(F.array(*flags))


def _copy(n: Column, n_own: Column, n_exact: Column, n_exact_own: Column) -> list[Column]:
    """Flags of the choice among n records of one sequence."""
    some_own = (n_own > 0) & (n_own < n)
    copies = F.when(some_own, n_own).otherwise(n)
    exact = F.when(some_own, n_exact_own).otherwise(n_exact)
    return [F.when(n > 1, IDENTICAL), F.when((n > 1) & some_own, OWN_LAB), F.when((n > 1) & (exact > 0) & (exact < copies), PASSAGE_EXACT)]


def judged(pairs: DataFrame) -> DataFrame:
    """(point, route, chosen, flags, s_chosen, s_flags, n_tied, ranked) of candidate pairs (point, route, wanted, steps, lowest, records, identity, class, c_steps, own).

    A row stands for `records` alike ones, of which `lowest` comes first.  Only
    the lowest route of a point counts.  The best passage class stays; of several
    sequences the one that the point's own laboratory deposited is taken; several
    records of one sequence give one; else the point is refused, and its
    candidates are tied: s_chosen is the one sequence among them with the very
    passage, n_tied counts them and ranked is the closest.
    """
    here = Window.partitionBy("point")
    low, high = (lambda c: F.min(c).over(here)), (lambda c: F.max(c).over(here))
    true = lambda c: F.coalesce(c, F.lit(False))
    pairs = pairs.withColumn("__first", low("route")).where("route = __first")
    pairs = pairs.withColumn("exact", (F.size("steps") > 0) & (F.col("class") != "unknown") & (F.col("c_steps") == F.col("steps")))
    pick = preference(F.col("wanted"), F.collect_set("class").over(here))
    rank = texts.passage_rank(F.col("steps"), F.col("wanted") == "egg", F.col("c_steps"), F.col("class") == "egg")
    tier = pairs.withColumn("pick", pick).where("pick.use = 'any' or pick.use = class").withColumn("rank", rank)
    mine = F.when(F.col("own"), F.col("identity"))
    by_own = true(low("identity") != high("identity")) & true(low(mine) == high(mine))
    tier = tier.withColumn("by_own", by_own).where("own or not by_own")

    count = lambda which: F.sum(F.when(which, F.col("records")).otherwise(0))
    own, exact, same = F.col("own"), F.col("exact"), F.when(F.col("exact"), F.col("identity"))
    record = F.struct("lowest.epi", "lowest.accession")
    # own deposits, then the very passage, then the closest one, then the lowest id
    order = F.struct((~own).alias("a"), (~exact).alias("b"), F.col("rank").alias("c"), F.col("lowest").alias("d"))
    grouped = tier.groupBy("point").agg(
        F.first("route").alias("route"),
        F.first("pick.flag").alias("picked"),
        F.first("by_own").alias("by_own"),
        F.sum("records").alias("n"),
        count(own).alias("n_own"),
        count(exact).alias("n_exact"),
        count(own & exact).alias("n_exact_own"),
        F.min_by(record, order).alias("best"),
        true(F.min("identity") == F.max("identity")).alias("one"),
        F.min_by(record, F.when(exact, order)).alias("s_best"),
        true(F.min(same) == F.max(same)).alias("s_one"),
        F.min_by("lowest.epi", F.struct("rank", "lowest")).alias("ranked"),
    )
    one, n, n_own, n_exact, n_exact_own = map(F.col, ("one", "n", "n_own", "n_exact", "n_exact_own"))
    copy = [F.when(one, f) for f in _copy(n, n_own, n_exact, n_exact_own)]
    flags = _flags(F.col("picked"), F.when(F.col("by_own"), OWN_LAB), *copy, F.when(~one, AMBIGUOUS))
    tied = lambda c: F.when(~one, c)
    return grouped.select(
        "point",
        "route",
        F.when(one, F.col("best")).alias("chosen"),
        F.array_distinct(flags).alias("flags"),
        tied(F.when(F.col("s_one"), F.col("s_best"))).alias("s_chosen"),
        tied(_flags(*_copy(n_exact, n_exact_own, n_exact, n_exact_own))).alias("s_flags"),
        tied(n).alias("n_tied"),
        tied(F.col("ranked")).alias("ranked"),
    )


def match(points: DataFrame, candidates: DataFrame, submitters: DataFrame, equivalents: DataFrame, number_rules: DataFrame) -> DataFrame:
    """(point, method, epi, accession, flags, n_tied, ranked, status) of every point.

    points: point (a row each), stated (an id or ''), location, isolate, year (NULL for a
    name of another shape), wanted (passage class), passage, reassortant, lab.
    candidates: epi, accession, location, isolate, year, class, passage,
    identity, submitter.  submitters: lab, submitter.  equivalents: lab,
    location, other.  number_rules: lab, scope (province or national).

    The stated id decides if the store has it.  Else the name, then the name
    with a location of letters and digits alone, then the laboratory's other
    spellings, each only if the one before found nothing; then, for a point
    without a sequence, the laboratory's own number; then, for a tie, the one
    sequence with the very passage.
    """
    points = points.withColumn("steps", texts.loose_steps(F.col("passage"))).drop("passage")
    records = candidates.withColumn("c_steps", texts.loose_steps(F.col("passage"))).drop("passage")
    records = records.withColumnsRenamed({"location": "c_location", "isolate": "c_isolate", "year": "c_year"})
    number = F.struct(texts.id_number(F.col("epi")).alias("number"), "epi", "accession")
    alike = records.groupBy("c_location", "c_isolate", "c_year", "class", "c_steps", "identity", "submitter")
    cand = settled(alike.agg(F.count("*").alias("records"), F.min(number).alias("lowest")), "candidates")
    owners = submitters.select(F.col("lab").alias("o_lab"), F.col("submitter").alias("o_submitter")).distinct()

    def with_own(pairs: DataFrame) -> DataFrame:
        both = pairs.join(owners.withColumn("__own", F.lit(True)), (F.col("lab") == F.col("o_lab")) & (F.col("submitter") == F.col("o_submitter")), "left")
        return both.withColumn("own", F.coalesce("__own", F.lit(False))).drop("__own", "o_lab", "o_submitter")

    # the stated id: what the store's records of it are called
    name = lambda *columns: F.struct(*[F.col(c).alias(n) for c, n in zip(columns, ("location", "isolate", "year"))])
    theirs = name("c_location", "c_isolate", "c_year")
    by_id = records.groupBy("epi").agg(
        F.count("*").alias("n"),
        F.coalesce(F.min("identity") == F.max("identity"), F.lit(False)).alias("one"),
        F.min(F.struct("epi", "accession")).alias("best"),
        F.min(theirs).alias("least"),
        F.max(theirs).alias("most"),
    )
    own_name = name("location", "isolate", "year")
    points = points.select("point", "stated", "location", "isolate", "year", "wanted", "steps", "reassortant", "lab")
    stated = points.where("stated <> ''").join(by_id, F.col("stated") == F.col("epi"), "left")
    stated = stated.withColumn("differs", ~(own_name.eqNullSafe(F.col("least")) & own_name.eqNullSafe(F.col("most")))).drop("epi", "least", "most")
    asked = settled(stated.unionByName(points.where("stated is null or stated = ''"), allowMissingColumns=True), "asked")

    # a point's name, class, passage and laboratory decide all else: one judgement for each such profile
    shared = ["location", "isolate", "year", "wanted", "steps", "lab"]
    keyed = asked.where("n is null and location is not null").groupBy(*shared).agg(F.min("point").alias("point"))
    keyed = settled(keyed, "profiles")

    same_rest = (F.col("isolate") == F.col("c_isolate")) & (F.col("year") == F.col("c_year"))
    same_name = (F.col("location") == F.col("c_location")) & same_rest
    squashed = lambda c: F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")
    other = equivalents.select(F.col("lab").alias("e_lab"), F.col("location").alias("e_location"), "other")
    left = keyed.join(cand, same_name, "left_anti")
    spelled = left.join(other, (F.col("lab") == F.col("e_lab")) & (F.col("location") == F.col("e_location"))).drop("e_lab", "e_location")
    routes = [
        ("name", None, keyed.join(cand, same_name)),
        ("location-forms", SPACING, left.join(cand, (squashed(F.col("location")) == squashed(F.col("c_location"))) & same_rest)),
        ("equivalent", EQUIVALENT, spelled.join(cand, (F.col("other") == F.col("c_location")) & same_rest).drop("other")),
    ]
    pairs = reduce(DataFrame.unionByName, [rows.withColumn("route", F.lit(i)) for i, (_, _, rows) in enumerate(routes)])
    found = judged(with_own(pairs))
    method, said = F.lit(None).cast("string"), F.coalesce("flags", F.array(F.lit(NONE)))
    for i, (known_as, flag, _) in enumerate(routes):
        method = F.when(F.col("route") == i, known_as).otherwise(method)
        said = F.when(F.col("route") == i, F.array_append(F.col("flags"), F.lit(flag))).otherwise(said) if flag else said
    named = keyed.join(found, "point", "left").withColumn("method", method).withColumn("flags", said).drop("route")
    named = settled(named, "named")

    # the laboratory's own number, for points without a sequence
    open_points = named.where("chosen is null").select("point", *shared).join(number_rules.select(F.col("lab").alias("n_lab"), "scope"), F.col("lab") == F.col("n_lab"))
    open_points = open_points.join(owners, F.col("lab") == F.col("o_lab")).drop("n_lab", "o_lab")
    # in the point's province or, if the rule is national, anywhere
    province = lambda c: F.concat(F.lit("="), F.split_part(c, F.lit(" "), F.lit(1)))
    open_points = open_points.withColumn("area", F.when(F.col("scope").eqNullSafe(F.lit("province")), province(F.col("location"))).otherwise(""))
    deposits = cand.withColumn("c_area", F.explode(F.array(F.lit(""), province(F.col("c_location")))))
    near = same_rest & (F.col("submitter") == F.col("o_submitter")) & (F.col("area") == F.col("c_area"))

    # only one district's records are judged, so each number's first and last district are looked up before
    here = Window.partitionBy("point")
    districts = deposits.groupBy("c_isolate", "c_year", "submitter", "c_area").agg(F.min("c_location").alias("low"), F.max("c_location").alias("high"))
    open_points = open_points.join(districts, near).withColumn("collides", F.min("low").over(here) != F.max("high").over(here))
    open_points = settled(open_points.select("point", *shared, "o_submitter", "area", "collides"), "open")
    result = judged(open_points.where("not collides").join(deposits, near).withColumn("own", F.lit(False)).withColumn("route", F.lit(0)))
    number = result.where("chosen is not null").select("point", F.col("chosen").alias("n_chosen"), F.col("flags").alias("n_flags"))
    both = named.join(number, "point", "left").join(open_points.where("collides").select("point", "collides").distinct(), "point", "left")
    taken = F.col("n_chosen").isNotNull()
    kept = F.array_except("flags", F.array(F.lit(NONE), F.lit(AMBIGUOUS)))
    said = F.when(taken, F.array_append(F.array_distinct(F.concat(kept, "n_flags")), F.lit(LAB_NUMBER))).when(F.col("collides"), F.array_append("flags", F.lit(COLLISION))).otherwise(F.col("flags"))
    both = both.withColumn("flags", said).withColumn("method", F.when(taken, "number").otherwise(F.col("method"))).withColumn("chosen", F.coalesce("n_chosen", "chosen"))

    # the one sequence of the very passage, for ties
    exact = F.col("chosen").isNull() & F.col("s_chosen").isNotNull()
    said = F.when(exact, F.array_append(F.array_distinct(F.concat(F.array_except("flags", F.array(F.lit(AMBIGUOUS))), "s_flags")), F.lit(PASSAGE_EXACT))).otherwise(F.col("flags"))
    judgement = both.select(*[F.col(c).alias(f"j_{c}") for c in shared], "method", F.coalesce("chosen", "s_chosen").alias("chosen"), said.alias("flags"), "n_tied", "ranked")
    stands_for = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"j_{c}")) for c in shared])
    rest = asked.where("n is null").select("point", "stated", "reassortant", *shared)
    rest = rest.join(judgement, stands_for, "left").select("point", "stated", "reassortant", "method", "chosen", F.coalesce("flags", F.array(F.lit(NONE))).alias("flags"), "n_tied", "ranked")

    flags = _flags(F.when(F.col("differs"), EPI_NAME_DIFFERS), F.when(F.col("one") & (F.col("n") > 1), IDENTICAL), F.when(~F.col("one"), SEVERAL))
    results = asked.where("n is not null").select("point", "stated", "reassortant", F.lit("epi").alias("method"), F.when(F.col("one"), F.col("best")).alias("chosen"), flags.alias("flags"))
    every = results.unionByName(rest, allowMissingColumns=True)
    first = _flags(F.when(F.col("reassortant") != "", REASSORTANT), F.when((F.col("stated") != "") & ~F.col("method").eqNullSafe(F.lit("epi")), EPI_NOT_IN_STORE))
    every = every.withColumn("flags", F.array_distinct(F.concat(first, "flags")))
    open_tie = F.col("chosen").isNull()
    status = F.when(open_tie, "unmatched").when(F.arrays_overlap("flags", F.array(*map(F.lit, DOUBTFUL))), "doubtful").otherwise("matched")
    return every.select("point", "method", "chosen.epi", "chosen.accession", "flags", F.coalesce(F.when(open_tie, F.col("n_tied")), F.lit(0)).alias("n_tied"), F.when(open_tie, F.col("ranked")).alias("ranked"), status.alias("status"))


def preparation_sequences(rows: DataFrame, key: str) -> DataFrame:
    """One sequence per preparation, or why there is none.

    rows: key, status, flags, epi, accession, identity, clade, score (of the
    record's passage against the preparation's), tied (array of ids).  Matched
    rows come first, then doubtful ones whose every doubt is usable, then
    refused ties.  Several records of one sequence, clade alike, are no
    conflict; of several sequences the only best passage wins, else none.
    """
    bad = F.array(*[F.lit(f) for f in DOUBTFUL if f not in (*USABLE, AMBIGUOUS)])
    refused = F.arrays_overlap("flags", bad)
    ambiguous = F.array_contains("flags", AMBIGUOUS)
    level = F.when(F.col("status") == "matched", 1).when((F.col("status") == "doubtful") & ~refused & ~ambiguous, 2).when((F.col("status") == "unmatched") & ambiguous & ~refused, 3)
    leveled = rows.withColumn("level", level).where("level is not null")
    first = leveled.groupBy(key).agg(F.min("level").alias("level"))
    used = leveled.join(first, [key, "level"])
    doubts = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.filter("flags", lambda f: f.isin(*USABLE))))))
    # a record is listed once per passage that it was deposited with: its best one counts
    records = used.where("level < 3").groupBy(key, "level", "epi", "accession").agg(F.max("score").alias("score"), F.first("identity").alias("identity"), F.first("clade").alias("clade"))
    number = F.struct(texts.id_number(F.col("epi")).alias("n"), "epi", "accession")
    here = Window.partitionBy(key)
    records = records.withColumn("top", (F.col("score") == F.max("score").over(here)) & (F.col("score") > 0))
    single = records.groupBy(key, "level").agg(
        F.count("*").alias("n"),
        F.count_distinct("identity").alias("identities"),
        F.count_if(F.col("identity").isNull()).alias("unknown"),
        F.count_distinct(F.coalesce("clade", F.lit("\x01"))).alias("clades"),
        F.count_if("top").alias("n_top"),
        F.min_by(F.struct("epi", "accession", "clade"), number).alias("lowest"),
        F.min_by(F.struct("epi", "accession", "clade"), F.when(F.col("top"), number)).alias("best"),
    )
    alike = (F.col("identities") == 1) & (F.col("unknown") == 0) & (F.col("clades") == 1)
    only_top = F.col("n_top") == 1
    pick = F.when(F.col("n") == 1, F.col("lowest")).when(alike, F.when(only_top, F.col("best")).otherwise(F.col("lowest"))).when(only_top, F.col("best"))
    how = F.when(F.col("n") == 1, "").when(alike, "same sequence").when(only_top, "passage matched").when(F.col("n_top") == 0, "none matches").otherwise("several match")
    single = single.select(key, pick.alias("pick"), how.alias("resolution"), ((F.col("n") > 1) & ~alike).alias("conflict"), F.lit(0).cast("long").alias("n_tied"))
    ties = used.where("level = 3").select(key, F.explode("tied").alias("id")).groupBy(key).agg(F.count_distinct("id").alias("n_tied"))
    nothing = F.lit(None).cast("struct<epi:string,accession:string,clade:string>")
    ties = ties.select(key, nothing.alias("pick"), F.lit("tied").alias("resolution"), F.lit(False).alias("conflict"), "n_tied")
    noted = used.groupBy(key, "level").agg(doubts.alias("doubts")).select(key, F.when(F.col("level") > 1, F.col("doubts")).otherwise(F.array().cast("array<string>")).alias("doubts"))
    return single.unionByName(ties).join(noted, key).select(key, "pick.epi", "pick.accession", "pick.clade", "resolution", "conflict", "n_tied", "doubts")
