"""Filters kept as curated rules, checks of tables, and what each rule did."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settled


class RuleError(ValueError):
    """A curated rule that doesn't fit the data."""


def require_none(problems: DataFrame, what: str) -> None:
    """Curated rules must fit: the first few rows that say otherwise are the error."""
    found = problems.limit(5).collect()
    if found:
        raise RuleError(f"{what}: {[tuple(r) for r in found]}")


def in_scope(rule: str, value: str) -> Column:
    """A rule's scope column equals the row's ignoring case, or is `*`."""
    return (F.col(rule) == "*") | (F.lower(F.col(rule)) == F.lower(F.col(value)))


def first_in_scope(rows: DataFrame, rules: DataFrame, scope: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Each distinct key with the first rule, by line, whose scope fits; patterns aren't asked."""
    here = reduce(lambda a, b: a & b, [in_scope(f"rule_{c}", c) for c in scope])
    hits = rows.select(*dict.fromkeys([*key, *scope])).distinct().join(rules, here, "left")
    first = hits.groupBy(*key).agg(F.min_by(F.struct("rule_line", "rule_value"), "rule_line").alias("hit"))
    return first.select(*key, F.col("hit.rule_line").alias("rule_line"), F.col("hit.rule_value").alias("rule_value"))


def qc_failures(most_unknown: int, most_deleted: int) -> Column:
    """Why an aligned record fails, from its columns; an unaligned one has that reason alone."""
    reasons = F.array_compact(
        F.array(
            F.when(~F.col("covers_mature"), "incomplete"),
            F.when(F.col("cds_failed") | F.col("protein").isNull(), "cds-failed"),
            F.when(F.col("frameshifts") > 0, "frameshift"),
            F.when(F.col("unknown_aa") > most_unknown, "unknown-aa"),
            F.when(F.col("deleted_aa") > most_deleted, "deleted-aa"),
            F.when(F.col("inserted_aa") > 0, "aa-insertion"),
            F.when(F.col("premature_stop"), "premature-stop"),
        )
    )
    return F.when(F.col("error").isNotNull(), F.array(F.lit("not-aligned"))).otherwise(reasons)


def fixed_cells(cells: DataFrame, fixes: DataFrame, where: Sequence[str]) -> DataFrame:
    """Cells with their curated values; a fix says what the cell must hold (`raw`), and is refused (state `stale`) where it doesn't.

    A fix may name a cell that the sheet lacks: it holds ''.
    """
    both = cells.join(fixes, list(where), "full_outer")
    held = F.coalesce(F.col("text"), F.lit(""))
    fits = F.col("raw") == held
    state = F.when(F.col("raw").isNull(), "").when(fits, "fixed").otherwise("stale")
    return both.select(*where, F.when(state == "fixed", F.col("value")).otherwise(held).alias("text"), state.alias("state"))


def rename_support(renames: DataFrame, cells: DataFrame, by: str) -> DataFrame:
    """Per renamed point, its tested cells and those that react; the rename stands if their share reaches the rule's.

    renames: (by, min_titre, min_fraction); cells: (by, cell, value) with 0 for less-than readings.  A cell reacts by its largest reading.
    """
    largest = cells.groupBy(by, "cell").agg(F.max("value").alias("value"))
    joined = renames.join(largest, by, "left")
    counted = joined.groupBy(by, "min_titre", "min_fraction").agg(F.count("value").alias("tested"), F.count_if(F.col("value") >= F.col("min_titre")).alias("reacting"))
    stands = (F.col("tested") > 0) & (F.col("reacting") >= F.col("min_fraction") * F.col("tested"))
    return counted.select(by, "tested", "reacting", stands.alias("stands"))


def restored_lots(sera: DataFrame, rules: DataFrame) -> DataFrame:
    """Sera with their restored id: the first rule of the laboratory whose pattern matches and whose ferret is the serum's."""
    whole = F.expr("lot rlike concat('(?i)^(?:', rule_pattern, ')$')")
    hits = sera.join(rules, in_scope("rule_lab", "lab") & (F.col("rule_ferret") == F.col("ferret")) & whole, "left")
    first = hits.groupBy("serum", "lot").agg(F.min_by("rule_value", "rule_line").alias("restored"), F.min("rule_line").alias("rule_line"))
    return first.select("serum", F.coalesce("restored", "lot").alias("lot"), "rule_line")


def id_outcomes(ids: DataFrame, shapes: DataFrame) -> DataFrame:
    """Each id against its laboratory's shapes in force: ok, missing, or of an unexpected shape; without shapes nothing is said."""
    force = in_scope("rule_lab", "lab") & (F.col("rule_field") == F.col("field")) & F.col("date").between(F.col("date_from"), F.col("date_to"))
    tested = ids.join(shapes, force)
    fits = F.expr("coalesce(id rlike concat('^(?:', rule_pattern, ')$'), false)")
    judged = tested.groupBy("key", "lab", "field", "id").agg(F.bool_or(fits).alias("fits"))
    outcome = F.when(F.coalesce(F.col("id"), F.lit("")) == "", "missing").when(F.col("fits"), "ok").otherwise("unexpected shape")
    return judged.withColumn("outcome", outcome)


def removed_points(points: DataFrame, rules: DataFrame) -> DataFrame:
    """(point, rule_line) of every point that a rule takes out: by passage class, or by a part of its name or designation."""
    kind, text = F.col("rule_kind"), F.col("rule_text")
    hit = ((kind == "passage") & (F.col("passage_class") == text)) | ((kind == "name") & F.contains("name", text)) | ((kind == "designation") & F.contains("designation", text))
    return points.join(rules, (F.col("rule_what") == F.col("what")) & hit).select("point", "rule_line")


def without_cells(readings: DataFrame, drops: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(readings with the named cells missing, what each rule found): a rule must name one present reading."""
    named = drops.select(*keys, F.lit(True).alias("__drop"))
    kept = readings.join(named, list(keys), "left").withColumn("token", F.when(F.col("__drop"), F.lit("*")).otherwise(F.col("token"))).drop("__drop")
    present = readings.where("token <> '*'").groupBy(*keys).agg(F.count("*").alias("n"))
    found = drops.join(present, list(keys), "left").select(*keys, F.coalesce("n", F.lit(0)).alias("n_present"))
    return kept, found


def deleted(protein: Column, positions: Sequence[int]) -> Column:
    """True if a protein has a gap at every position, False if a residue is read at one, NULL where that can't be seen."""
    calls = [F.when(F.length(protein) >= p, F.substr(protein, F.lit(p), F.lit(1))) for p in positions]
    read = reduce(lambda a, b: a | b, [F.coalesce(~c.isin("-", "X"), F.lit(False)) for c in calls])
    gaps = reduce(lambda a, b: a & b, [F.coalesce(c == "-", F.lit(False)) for c in calls])
    return F.when(read, False).when(gaps, True)


def early_points(points: DataFrame, until: str) -> DataFrame:
    """Points seen only in tables dated up to a day, each with the first such table by (date, table)."""
    early = F.col("date") <= F.lit(until).cast("date")
    grouped = points.groupBy("point").agg(F.bool_and(early).alias("early"), F.min_by("table_id", F.struct("date", "table_id")).alias("table_id"))
    return grouped.where("early").drop("early")


def serum_kind(species: Column, markers: Sequence[tuple[str, Column]]) -> Column:
    """Why a serum isn't a ferret's: its species, else the first marker that holds; NULL for a ferret's."""
    text = F.upper(F.trim(species))
    marked = reduce(lambda rest, m: F.when(m[1], F.lit(f"marker {m[0]}")).otherwise(rest), reversed(list(markers)), F.lit(None).cast("string"))
    return F.when((text != "") & (text != "FERRET"), F.concat(F.lit("species "), text)).when(text == "", marked)


def placed(records: DataFrame, rules: DataFrame) -> DataFrame:
    """Each record's dataset by (subtype, lineage); a record that no rule places is an error."""
    both = records.join(rules, ["subtype", "lineage"], "left")
    require_none(both.where("dataset is null").groupBy("subtype", "lineage").count(), "records without a dataset")
    return both


def report_leaves(leaves: DataFrame, titrated_ids: DataFrame, titrated_names: DataFrame, cutoff: str) -> DataFrame:
    """Leaves with how they are titrated (by id, else by name) and whether a report's tree keeps them.

    An untitrated leaf goes if its whole collection interval lies before the cutoff; undated leaves stay.
    """
    ids = titrated_ids.select("epi", F.lit(True).alias("__id")).distinct()
    by_name = titrated_names.select("name", F.lit(True).alias("__name")).distinct()
    both = leaves.join(ids, "epi", "left").join(by_name, "name", "left")
    titrated = F.when(F.col("__id"), "epi").when(F.col("__name"), "name")
    old = F.col("last") < F.lit(cutoff).cast("date")
    state = F.when(titrated.isNotNull(), "titrated").when(old.isNull(), "undated").when(old, "old").otherwise("recent")
    return both.select("leaf", titrated.alias("titrated"), state.alias("state"), (state != "old").alias("kept"))


def long_branches(leaves: DataFrame, threshold: float, keep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves to leave out with their lengths, counts): at or over the threshold and not exempt; an inert threshold shows."""
    marked = leaves.join(keep.select("leaf", F.lit(True).alias("exempt")), "leaf", "left").fillna(False, ["exempt"])
    over = F.col("length") >= threshold
    drop = marked.where(over & ~F.col("exempt")).select("leaf", "length")
    counts = marked.agg(F.count("*").alias("measured"), F.count_if(over & ~F.col("exempt")).alias("dropped"), F.count_if(over & F.col("exempt")).alias("exempt"), F.max("length").alias("longest"))
    return drop, counts.withColumn("inert", F.lit(threshold) > F.col("longest"))


def shown(leaves: DataFrame, below_long: DataFrame, names: Sequence[str], flags: DataFrame, reasons: Sequence[str]) -> DataFrame:
    """Each leaf with the rule that hides it: under a long branch, by name, or by the first of its flags; '' if it is drawn."""
    hit = flags.where(F.col("reason").isin(*reasons)).groupBy("leaf").agg(F.min("reason").alias("reason"))
    both = leaves.join(below_long.select("leaf", F.lit(True).alias("long")).distinct(), "leaf", "left").join(hit, "leaf", "left")
    rule = F.when(F.col("long"), "long branch").when(F.col("name").isin(*names), "named override").when(F.col("reason").isNotNull(), F.concat(F.lit("flag: "), "reason")).otherwise("")
    return both.select("leaf", rule.alias("hidden_by"))


def table_problems(tables: DataFrame) -> DataFrame:
    """What is wrong with nested tables (antigens, sera, titres): sizes that disagree, and in sound ones points without titres."""
    n_ag, n_sr = F.size("antigens"), F.size("sera")
    ragged = F.size(F.filter("titres", lambda row: F.size(row) != n_sr))
    shape = F.array_compact(
        F.array(
            F.when(n_ag == 0, F.lit("no antigens")),
            F.when(n_sr == 0, F.lit("no sera")),
            F.when(F.size("titres") != n_ag, F.lit("titre rows differ from antigens")),
            F.when(ragged > 0, F.concat(ragged.cast("string"), F.lit(" ragged rows"))),
        )
    )
    empty_rows = F.size(F.filter("titres", lambda row: F.forall(row, lambda cell: F.size(cell) == 0)))
    empty_sera = F.size(F.filter(F.sequence(F.lit(0), F.greatest(n_sr - 1, F.lit(0))), lambda j: F.forall("titres", lambda row: F.size(F.get(row, j)) == 0)))
    content = F.array_compact(
        F.array(
            F.when(empty_rows > 0, F.concat(empty_rows.cast("string"), F.lit(" antigens without titres"))),
            F.when(empty_sera > 0, F.concat(empty_sera.cast("string"), F.lit(" sera without titres"))),
        )
    )
    return tables.select("table_id", F.explode(F.when(F.size(shape) > 0, shape).otherwise(content)).alias("problem"))


def kept_by_cut(records: DataFrame, below: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Records below the cut, or unknown when it was chosen."""
    above = known.join(below.select(key), key, "left_anti").select(key).distinct()
    return records.join(above, key, "left_anti")


def withheld(lists: DataFrame) -> DataFrame:
    """(id, rule): of several rules that withhold an id the first by subtype and order."""
    return lists.groupBy("id").agg(F.min_by(F.concat_ws(".", "subtype", "rule"), F.struct("subtype", "place")).alias("rule"))


def unknown(stated: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Stated values that a curated table lacks."""
    return stated.join(known.select(key).distinct(), key, "left_anti")


def majority(statements: DataFrame, by: str, values: Sequence[str]) -> DataFrame:
    """Each key's most frequent statement, ties to the least values; and how many statements it has."""
    counted = statements.groupBy(by, *values).agg(F.count("*").alias("n"))
    order = F.struct((-F.col("n")).alias("n"), *values)
    return counted.groupBy(by).agg(F.min_by(F.struct(*values), order).alias("x"), F.sum("n").alias("n")).select(by, "x.*", "n")


#: What an unparsed name's warning looks like, and how a strain's name begins (fixed values).
UNPARSED, STRAIN_LIKE = r"name '(.*)': expected type/location/isolate/year", r"(?i)^\s*[AB]\s*/"


def warning_class(text: Column, applied: Mapping[str, str], tolerated: Mapping[str, str]) -> tuple[Column, Column]:
    """(class, kind) of a reader's warning: applied, expected, tolerated or review; the first pattern that is found decides."""
    kind, cls = F.lit("unclassified"), F.lit("review")
    for name, patterns in (("tolerated", tolerated), ("applied", applied)):
        for label, pattern in reversed(patterns.items()):
            kind, cls = F.when(text.rlike(pattern), label).otherwise(kind), F.when(text.rlike(pattern), name).otherwise(cls)
    unparsed, like = text.rlike(UNPARSED), F.regexp_extract(text, UNPARSED, 1).rlike(STRAIN_LIKE)
    kind = F.when(unparsed & like, "begins like a strain name and does not parse").when(unparsed, "not a strain name").otherwise(kind)
    return F.when(unparsed & like, "review").when(unparsed, "expected").otherwise(cls), kind


def bad_outputs(warnings: DataFrame) -> DataFrame:
    """Names that a rule wrote (output, rule) and that the parser then flags in the same table (flagged)."""
    wrote = warnings.where("output is not null").select("table_id", F.col("output").alias("name"), "rule").distinct()
    return warnings.where("flagged is not null").select("table_id", F.col("flagged").alias("name")).distinct().join(wrote, ["table_id", "name"])


def exact_repeats(tables: DataFrame, content: str, order: str) -> DataFrame:
    """Tables that repeat an earlier one's whole content, with that one."""
    window = Window.partitionBy(content).orderBy(order)
    ranked = tables.withColumn("first", F.first("table_id").over(window)).withColumn("__place", F.row_number().over(window))
    return ranked.where("__place > 1").select("table_id", F.col("first").alias("repeats"))


#: Tables of up to so many members are found by pairs of members, larger ones by single members.
PAIRED = 24


def likely_repeats(a: DataFrame, b: DataFrame, on: Sequence[str], least: int = 1) -> DataFrame:
    """Pairs of tables of two deliveries on one day of which more than half of the first one's members are in the second.

    Members are rows (table_id, *on, member) without repeats; first tables of
    fewer than `least` members are left out.

    If t members must be shared, the first one's m - t + 1 rarest members hold
    one of them, and its m - t + 2 rarest two, so tables meet by one or two rare
    members that both have.  Those that meet are compared member by member.
    """
    keys = [*on, "member"]
    known = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in keys])
    hashed = F.when(known, F.xxhash64(*keys))
    second = b.withColumnRenamed("table_id", "other").withColumn("__h", hashed)
    often = second.where(known).groupBy("__h").agg(F.count("*").alias("__often"))
    first = a.where("table_id is not null").withColumn("__h", hashed).join(often, "__h", "left")
    rare = F.when(F.col("__often").isNotNull(), F.struct("__often", "__h"))
    mine = first.groupBy("table_id").agg(F.count("*").alias("size"), F.array_sort(F.collect_list(rare)).getField("__h").alias("mine"))
    mine = mine.where(F.col("size") >= least).withColumn("must", F.floor(F.col("size") / 2).cast("int") + 1).where(F.size("mine") >= F.col("must"))
    mine = settled(mine, "mine")
    theirs = settled(second.where(known).groupBy("other").agg(F.collect_list("__h").alias("theirs")), "theirs")

    two = lambda h: F.flatten(F.transform(h, lambda x, i: F.transform(F.slice(h, i + 2, F.size(h)), lambda y: F.xxhash64(F.least(x, y), F.greatest(x, y)))))
    rarest = lambda more: F.slice("mine", 1, F.least(F.size("mine"), F.size("mine") - F.col("must") + more))
    meet = lambda x, mine_by, y, theirs_by: x.select("table_id", F.explode(mine_by).alias("__k")).join(y.select("other", F.explode(theirs_by).alias("__k")), "__k").select("table_id", "other")
    small = F.size("theirs") <= PAIRED
    met = meet(mine.where(F.col("must").between(2, PAIRED)), two(rarest(2)), theirs.where(small), two(F.col("theirs")))
    if not (large := theirs.where(~small)).isEmpty():
        met = met.unionByName(meet(mine.where("must > 1"), rarest(1), large, F.col("theirs")))
    if least <= 1:
        met = met.unionByName(meet(mine.where("must = 1"), F.col("mine"), theirs, F.col("theirs")))
    both = met.distinct().join(mine, "table_id").join(theirs.withColumnRenamed("other", "__other"), F.col("other").eqNullSafe(F.col("__other")))
    # hashes may only count too many; the members themselves decide
    most = F.size("theirs") - F.size(F.array_except("theirs", "mine"))
    close = settled(both.where(most >= F.col("must")).select("table_id", "other", "size"), "close")
    pairs = close.join(a, "table_id").withColumnRenamed("other", "__other").join(second.drop("__h"), keys).where("other <=> __other")
    shared = pairs.groupBy("table_id", "other", "size").agg(F.count("*").alias("shared"))
    return shared.where("2 * shared > size").select("table_id", "other", "shared", "size")


def override_bases(bases: DataFrame, named: DataFrame, value: float) -> DataFrame:
    """Bases with the named sera's at a value; every name must be one serum."""
    hits = named.join(bases.select(F.col("designation"), F.lit(1).alias("__one")), "designation", "left").groupBy("designation").agg(F.count("__one").alias("n"))
    require_none(hits.where("n <> 1"), "sera that a basis rule names")
    marked = bases.join(named.select("designation", F.lit(True).alias("__named")).distinct(), "designation", "left")
    return marked.withColumn("was", F.col("basis")).withColumn("basis", F.when(F.col("__named"), F.lit(value)).otherwise(F.col("basis"))).drop("__named")


def lowered_bases(bases: DataFrame, named: DataFrame | None, by: float) -> tuple[DataFrame, DataFrame]:
    """(bases lowered for the named sera or all, how many changed and the most)."""
    marked = bases.withColumn("__named", F.lit(True)) if named is None else bases.join(named.select("designation", F.lit(True).alias("__named")).distinct(), "designation", "left")
    new = marked.withColumn("was", F.col("basis")).withColumn("basis", F.when(F.col("__named"), F.col("basis") - by).otherwise(F.col("basis"))).drop("__named")
    change = F.abs(F.col("basis") - F.col("was"))
    return new, new.agg(F.count_if(change > 1e-9).alias("n_changed"), F.coalesce(F.max(F.when(change > 1e-9, change)), F.lit(0.0)).alias("most"))


def labelled_vaccines(marks: DataFrame, subtype_list: DataFrame | None, lab_list: DataFrame | None) -> DataFrame:
    """The marked vaccines that get a label: all, or those of the most specific list that there is; its rules must each match."""
    rules = lab_list if lab_list is not None else subtype_list
    if rules is None:
        return marks
    wanted = rules.select(F.col("strain").alias("__strain"), F.col("passage").alias("__passage"))
    fits = (F.col("strain") == F.col("__strain")) & ((F.col("__passage") == "any") | (F.col("__passage") == F.col("passage")))
    require_none(wanted.join(marks, fits, "left_anti"), "label rules that match no vaccine")
    return marks.join(wanted, fits, "left_semi")


def limited(measured: DataFrame, limits: DataFrame, key: str) -> DataFrame:
    """Measures with their key's limit; a key without one is an error."""
    both = measured.join(limits, key, "left")
    require_none(both.where("`limit` is null").select(key).distinct(), "no limit for")
    return both.withColumn("over", F.col("value") > F.col("limit"))
