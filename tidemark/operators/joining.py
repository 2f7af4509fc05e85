"""Guarded and cascaded joins: enrichment, places, abbreviations, homology, labels, merged tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settled

from .filters import require_none
from .order import numbered


def enriched(rows: DataFrame, facts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows with a fact that their key has exactly one of; state says found, ambiguous or none."""
    known = facts.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count_distinct(value).alias("__n"), F.min(value).alias("__value"))
    both = rows.join(known, list(keys), "left")
    one = F.col("__n") == 1
    state = F.when(F.col("__n").isNull(), "none").when(one, "found").otherwise("ambiguous")
    return both.withColumn(value, F.when(one, F.col("__value"))).withColumn("state", state).drop("__n", "__value")


def with_metadata(sequences: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Every sequence with its metadata row; a sequence without one, or a row without an accession, is an error."""
    require_none(sequences.join(metadata, key, "left_anti").select(key), "sequences without metadata")
    both = sequences.join(metadata, key)
    require_none(both.where("coalesce(accession, '') = ''").select(key), "rows without an accession")
    return both


def clade_rows(parts: Sequence[DataFrame]) -> DataFrame:
    """Clade rows of several files, evidence NULL where an old file lacks it; a row from a tree needs its evidence."""
    empty = {c: F.lit(None).cast("string") for c in ("clade_evidence", "supported_clade")}
    whole = [p.withColumns({c: v for c, v in empty.items() if c not in p.columns}) for p in parts]
    rows = reduce(lambda a, b: a.unionByName(b), whole)
    require_none(rows.where("source = 'tree' and clade_evidence is null").select("key"), "tree rows without evidence")
    return rows


def _letters(text: Column) -> Column:
    return F.regexp_replace(F.upper(text), r"[\s\-_.'’]", "")


def abbreviated(short: DataFrame, names: DataFrame) -> DataFrame:
    """(short, name) pairs: isolate and year equal, the location's letters begin the name's; where no name's do, they stand in it in order.

    short: short, table_id, location, isolate, year; names: table_id, name, full, isolate, year.
    """
    both = short.withColumnRenamed("location", "__loc").join(names, ["table_id", "isolate", "year"])
    mine, whole = _letters(F.col("__loc")), _letters(F.col("full"))
    begins = F.startswith(whole, mine)
    spread = F.concat(F.lit("^"), F.array_join(F.split(mine, ""), ".*"))
    in_order = (mine != "") & F.rlike(whole, spread)
    hits = both.withColumn("begins", begins).where(begins | in_order)
    best = F.max("begins").over(Window.partitionBy("short"))
    return hits.withColumn("best", best).where("begins = best").select("short", "name").distinct()


def resolved_places(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Rows with their place: by location and country if a country is stated, else by a location that is one place; else why not."""
    bare = places.groupBy("location").agg(F.count("*").alias("n"), F.min("place").alias("only"))
    exact = places.select("location", F.col("country").alias("__country"), F.col("place").alias("__place"))
    both = rows.join(bare, "location", "left").join(exact.withColumnRenamed("location", "__location"), (F.col("location") == F.col("__location")) & (F.col("country") == F.col("__country")), "left")
    place = F.when(F.col("country").isNotNull(), F.col("__place")).when(F.col("n") == 1, F.col("only"))
    state = F.when(place.isNotNull(), "found").when(F.col("n").isNull(), "unknown").when(F.col("country").isNull(), "ambiguous").otherwise("not in country")
    return both.select(*rows.columns, place.alias("place"), state.alias("state"))


def nth_of_day(left: DataFrame, right: DataFrame, day: str, order: str) -> DataFrame:
    """Pairs of two lists by day and place within it; what has no partner stays with NULLs."""
    place = F.row_number().over(Window.partitionBy(day).orderBy(order))
    return left.withColumn("__n", place).join(right.withColumn("__n", place).withColumnRenamed(order, f"{order}_other"), [day, "__n"], "full_outer").drop("__n")


def paired(primary: DataFrame, secondary: DataFrame, key: str, index: str) -> DataFrame:
    """Points of two charts with one key in index order, each used once; NULL keys match nothing."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(index))
    a = primary.where(F.col(key).isNotNull()).withColumn("__n", place)
    b = secondary.where(F.col(key).isNotNull()).withColumn("__n", place)
    return a.select(key, "__n", F.col(index).alias("i")).join(b.select(key, "__n", F.col(index).alias("j")), [key, "__n"]).select("i", "j")


def original_records(records: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """(records used, how): a strain's originals, else its cell records, never egg ones."""
    kinds = records.groupBy(by).agg(F.bool_or(F.col("class") == "original").alias("o"), F.bool_or(F.col("class") == "cell").alias("c"))
    how = kinds.select(by, F.when(F.col("o"), "original").when(F.col("c"), "cell").alias("how"))
    return records.join(how, by).where("class = how").drop("how"), how


def homologous(antigens: DataFrame, sera: DataFrame) -> DataFrame:
    """(serum, antigen): name, reassortant and egg-ness equal; annotations too, unless no antigen has them.

    Which of the two holds for a serum is asked before the pairs are made, so only pairs of the result are.
    """
    point = ["name", "reassortant", "egg"]
    a = antigens.where("annotations is not null").select("antigen", *point, "annotations")
    noted = a.select(*point, "annotations").distinct().withColumn("exact", F.lit(True))
    told = sera.where("annotations is not null").join(noted, [*point, "annotations"], "left").fillna(False, ["exact"])
    told = told.withColumn("best", F.max("exact").over(Window.partitionBy("serum")))
    # few rows that make very many pairs: their number of tasks must not follow from their size
    told = settled(told, "homology").repartition(int(sera.sparkSession.conf.get("spark.sql.shuffle.partitions")), "serum")
    exact = told.where("exact").join(a, [*point, "annotations"])
    rest = told.where("not best").join(a.drop("annotations"), point)
    return exact.select("serum", "antigen").unionByName(rest.select("serum", "antigen"))


#: What a serum's antigen may differ in, and what it costs; a kind is asked only where the passages differ.
PROFILE = ("annotations", "reassortant", "passage", "kind")
_COSTS = [(a + r + p, (a == 0, r == 0, p == 0, p == 4)) for a in (0, 16) for r in (0, 8) for p in (0, 4, 6)]


def _by_cost(rows: DataFrame) -> DataFrame:
    """Each profile once per cost, with only the columns that must agree at that cost."""
    keys = [F.struct(F.lit(cost).alias("cost"), *[F.when(F.lit(k), F.col(c)).alias(c) for c, k in zip(PROFILE, kept)]) for cost, kept in _COSTS]
    own = [c for c in rows.columns if c not in PROFILE]
    return rows.select(*own, F.explode(F.array(*keys)).alias("__key")).select(*own, "__key.*")


def coverage_antigen(antigens: DataFrame, sera: DataFrame, titrated: DataFrame | None = None) -> DataFrame:
    """Each serum's best-ranked titrated antigen of its name: annotations cost 16, reassortant 8, passage 4 and its kind 2 more.

    titrated: (serum, antigen); without it each of `antigens` is titrated with
    every serum of its name, and profiles are compared instead of pairs: the
    least cost at which an antigen agrees in all that must is its cost.
    """
    if titrated is not None:
        a = antigens.withColumnsRenamed({c: f"a_{c}" for c in PROFILE})
        both = titrated.select("serum", "antigen").distinct().join(sera, "serum").join(a, ["antigen", "name"])
        differs = lambda c: ~F.col(c).eqNullSafe(F.col(f"a_{c}"))
        cost = differs("annotations").cast("int") * 16 + differs("reassortant").cast("int") * 8 + F.when(differs("passage"), 4 + 2 * differs("kind").cast("int")).otherwise(0)
        return both.groupBy("serum").agg(F.min_by("antigen", F.struct(cost, "antigen")).alias("antigen"), F.min(cost).alias("cost"))
    same = lambda left, right, columns: reduce(lambda x, y: x & y, [left[c].eqNullSafe(right[c]) for c in columns], left["name"] == right["name"])
    known = _by_cost(antigens.where("antigen is not null").groupBy("name", *PROFILE).agg(F.min("antigen").alias("antigen")))
    known = known.groupBy("name", "cost", *PROFILE).agg(F.min("antigen").alias("antigen"))
    profiles = sera.select("name", *PROFILE).distinct()
    asked = _by_cost(profiles.withColumn("own", F.struct(*PROFILE)))
    met = asked.join(known, same(asked, known, ["cost", *PROFILE])).select(asked["name"], "own", asked["cost"], known["antigen"])
    best = met.groupBy("name", "own").agg(F.min(F.struct("cost", "antigen")).alias("best")).select("name", "own.*", "best")
    both = sera.join(best, same(sera, best, PROFILE))
    return both.groupBy("serum").agg(F.min("best").alias("best")).select("serum", "best.antigen", "best.cost")


def first_dataset(matches: DataFrame, by: str, order: str) -> DataFrame:
    """Matches found in several datasets: the first one stays, flagged."""
    here = Window.partitionBy(by).orderBy(order)
    both = matches.withColumn("__n", F.row_number().over(here)).withColumn("several", F.count("*").over(Window.partitionBy(by)) > 1)
    return both.where("__n = 1").drop("__n")


def by_leaf_set(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Nodes of two trees with one set of leaves, by the sets' ids (node, id)."""
    return ours.select("id", F.col("node").alias("ours")).join(theirs.select("id", F.col("node").alias("theirs")), "id").select("ours", "theirs")


def canonical_labels(labels: DataFrame, routes: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Each label's canonical name by the first route (label, canonical) that knows it; route '' and NULL for none."""
    out = labels.select("label").distinct().withColumns({"canonical": F.lit(None).cast("string"), "route": F.lit("")})
    for name, table in routes:
        known = table.select("label", F.col("canonical").alias("__new")).dropDuplicates(["label"])
        both = out.join(known, "label", "left")
        new = F.col("canonical").isNull() & F.col("__new").isNotNull()
        out = both.select("label", F.when(new, F.col("__new")).otherwise(F.col("canonical")).alias("canonical"), F.when(new, name).otherwise(F.col("route")).alias("route"))
    return out


def successors(clades: DataFrame) -> DataFrame:
    """(revoked, successor): the one live clade with a revoked one's unaliased name; several are none."""
    live = clades.where("not revoked").groupBy("unaliased").agg(F.count("*").alias("n"), F.min("name").alias("successor")).where("n = 1")
    return clades.where("revoked").join(live, "unaliased", "left").select(F.col("name").alias("revoked"), "successor")


def continent_of(rows: DataFrame, spellings: DataFrame, continents: DataFrame) -> DataFrame:
    """Rows with their country's continent, or why there is none."""
    both = rows.join(spellings.select("country", "code"), "country", "left").join(continents.select("code", "continent"), "code", "left")
    why = F.when(F.coalesce(F.col("country"), F.lit("")) == "", "no country").when(F.col("code").isNull(), "unknown spelling").when(F.col("continent").isNull(), "no continent").otherwise("")
    return both.select(*rows.columns, "continent", why.alias("missing"))


def reference_antigens(antigens: DataFrame, sera: DataFrame) -> DataFrame:
    """Antigens, DISTINCT ones left out, whose name and annotations a serum has."""
    return antigens.where("annotations <> 'DISTINCT'").join(sera.select("name", "annotations").distinct(), ["name", "annotations"], "left_semi")


def problem_differences(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Cells that two optimisation problems don't share or don't agree on."""
    left = a.select(*keys, F.col(value).alias("a"), F.lit(True).alias("__a"))
    right = b.select(*keys, F.col(value).alias("b"), F.lit(True).alias("__b"))
    both = left.join(right, list(keys), "full_outer")
    return both.where(F.col("__a").isNull() | F.col("__b").isNull() | ~F.col("a").eqNullSafe(F.col("b"))).drop("__a", "__b")


def merged_points(points: DataFrame, key: str) -> DataFrame:
    """The points of tables merged in order: (key, index, first table), by first appearance.

    points: key, table_order, table_id, place; a table holds a key once.  A
    point that is never compared has a key of its own, as table_id#place.
    """
    first = points.groupBy(key).agg(F.min(F.struct("table_order", "place", "table_id")).alias("f"))
    order = [F.col("f.table_order"), F.col("f.place"), F.col(key)]
    placed = numbered(first, order, "index")
    return placed.select(key, (F.col("index") - 1).alias("index"), F.col("f.table_id").alias("first_table"))


def merge_steps(points: DataFrame, key: str) -> DataFrame:
    """Per table of a merge how many of its points were there already, and how many are new."""
    first = points.groupBy(key).agg(F.min("table_order").alias("first"))
    both = points.join(first, key)
    return both.groupBy("table_id").agg(F.count_if(F.col("table_order") > F.col("first")).alias("n_matched"), F.count_if(F.col("table_order") == F.col("first")).alias("n_new"))


def repeated_points(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Points that one table holds twice; a merge refuses them."""
    return points.groupBy("table_id", *keys).agg(F.count("*").alias("n")).where("n > 1")
