"""Columns for passages, mutations, loci, ids, labels and other short texts."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def control_log(titre: Column) -> Column:
    """A control chart's log of a titre: log2(v / 10), or log2(v / 20) behind `<`; minus infinity for zero, NaN if unreadable."""
    number = F.try_to_number(F.regexp_replace(titre, "<", ""), F.lit("999999999999")).cast("double")
    scaled = number / F.when(F.contains(titre, F.lit("<")), 20.0).otherwise(10.0)
    return F.when(titre.isNull(), None).when(number.isNull(), F.lit(float("nan"))).when(number == 0, F.lit(float("-inf"))).otherwise(F.log2(scaled))


def is_dilution(value: Column) -> Column:
    """Whether a number is 10 * 2^k."""
    tenth = F.floor(value / 10).cast("long")
    return (value >= 10) & (value % 10 == 0) & (tenth.bitwiseAND(tenth - 1) == 0)


def extra_parts(extra: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(reassortant, annotation) of the text after a name's year; a rule (pattern, canonical) makes it a reassortant."""
    text = F.trim(extra)
    text = F.when(text.rlike(r"^\([^()]*\)$"), F.trim(F.substr(text, F.lit(2), F.length(text) - 2))).otherwise(text)
    reassortant, found = F.lit(""), F.lit(False)
    for pattern, canonical in reversed(rules):
        hit = text.rlike(f"(?i)^(?:{pattern})$")
        reassortant = F.when(hit, F.upper(F.regexp_replace(text, f"(?i){pattern}", canonical))).otherwise(reassortant)
        found = found | hit
    return reassortant, F.when(found, "").otherwise(text)


def name_location(name: Column) -> Column:
    """The location of a name of four parts; NULL for other names and an empty one."""
    parts = F.split(name, "/")
    return F.when(F.size(parts) == 4, F.nullif(F.element_at(parts, 2), F.lit("")))


@F.pandas_udf(StringType())
def ascii_location(texts: pd.Series) -> pd.Series:
    """A location in upper ASCII: marks go, hyphens and underscores are spaces, apostrophes and points go."""
    plain = texts.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii").str.upper()
    return plain.str.replace("[-_]", " ", regex=True).str.replace("['.]", "", regex=True).str.split().str.join(" ")


def location_parts(text: Column) -> tuple[Column, Column, Column]:
    """(region, country, rest) of `region / country / division / ...`; a missing part is NULL, a missing rest ''."""
    parts = F.when(F.trim(text) == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(text, " / "), lambda p: F.trim(p)))
    rest = F.array_join(F.when(F.size(parts) > 2, F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(1)))).otherwise(F.array().cast("array<string>")), " / ")
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), rest


#: Places of month, day and year in a date's three numbers (fixed values).
ORDERS = {"MDY": (0, 1, 2), "DMY": (1, 0, 2), "YMD": (1, 2, 0)}


def lab_date(text: Column, order: Column, not_after: Column) -> tuple[Column, Column]:
    """(date, problem) of a laboratory's date in its stated order.

    A four-digit first number is a year.  If the stated order gives no date but
    the others give exactly one, that is read, with `other order`; else the
    date is NULL with `ambiguous` or `invalid`.  Two digits are 20yy, or 19yy
    from 50 on if 20yy lies after not_after's year.
    """
    value = F.trim(text)
    iso = F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}( 00:00:00)?$"), F.try_to_date(F.substring(value, 1, 10), "yyyy-MM-dd"))
    shape = r"^(\d{1,4})[/.-](\d{1,2})[/.-](\d{1,4})$"
    shaped = value.rlike(shape)
    part = [F.regexp_extract(value, shape, k) for k in (1, 2, 3)]

    def built(name: str) -> Column:
        mi, di, yi = ORDERS[name]
        number, size = part[yi].cast("int"), F.length(part[yi])
        late = not_after.isNotNull() & (number + 2000 > F.year(not_after)) & (number >= 50)
        year = F.when(size == 4, number).when(size == 2, number + F.when(late, 1900).otherwise(2000))
        usable = shaped & year.isNotNull() & ((F.length(part[0]) == 4) if name == "YMD" else F.lit(True))
        month, day = part[mi].cast("int"), part[di].cast("int")
        padded = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(day.cast("string"), 2, "0"))
        return F.when(usable & (month <= 12) & (day <= 31), F.try_to_date(padded, "yyyy-MM-dd"))

    stated = F.when(F.length(part[0]) == 4, F.lit("YMD")).otherwise(order)
    dates = {name: built(name) for name in ORDERS}
    first = reduce(lambda rest, name: F.when(stated == name, dates[name]).otherwise(rest), ORDERS, F.lit(None).cast("date"))
    others = F.array_distinct(F.array_compact(F.array(*[F.when(stated != name, dates[name]) for name in ORDERS])))
    date = F.coalesce(iso, first, F.when(F.size(others) == 1, F.get(others, F.lit(0))))
    problem = F.when(iso.isNotNull() | first.isNotNull(), "").when(~shaped, "not a date").when(F.size(others) == 1, "other order")
    return date, problem.when(F.size(others) > 1, "ambiguous").otherwise("invalid")


def passage(text: Column, tokens: Sequence[tuple[str, str, str]]) -> tuple[Column, Column, Column]:
    """(canonical passage, classes of its steps, problem) by tokens (spelling, canonical, class).

    Segments stand between slashes; a step is a token, a count or X (written
    `?`), and a note in brackets; a step named like the one before it follows a
    slash.  A text that cannot be read stays, in upper case, without classes.
    """
    spellings = sorted({t[0] for t in tokens}, key=len, reverse=True)
    step = r"(?i)(" + "|".join(spellings) + r")(\d+|X)?(\([^()]*\))?"
    first = {}
    for spelling, canonical, kind in tokens:
        first.setdefault(spelling.upper(), (canonical, kind))
    canonical = F.create_map(*[F.lit(x) for s, (c, _) in first.items() for x in (s, c)])
    kinds = F.create_map(*[F.lit(x) for s, (_, k) in first.items() for x in (s, k)])
    value = F.trim(text)
    segments = F.split(value, "/")
    readable = F.forall(segments, lambda s: (s != "") & (F.regexp_replace(s, step, "") == ""))

    def written(segment: Column) -> Column:
        steps = F.transform(
            F.regexp_extract_all(segment, F.lit(step), F.lit(0)),
            lambda m: F.struct(
                F.element_at(canonical, F.upper(F.regexp_extract(m, step, 1))).alias("name"),
                F.concat(F.when(F.upper(F.regexp_extract(m, step, 2)) == "X", "?").otherwise(F.regexp_extract(m, step, 2)), F.upper(F.regexp_extract(m, step, 3))).alias("rest"),
            ),
        )
        start = F.struct(F.lit("").alias("text"), F.lit("").alias("last"))
        glued = lambda acc, x: F.struct(F.concat(acc["text"], F.when((acc["text"] != "") & (acc["last"] == x["name"]), "/").otherwise(""), x["name"], x["rest"]).alias("text"), x["name"].alias("last"))
        return F.aggregate(steps, start, glued, lambda acc: acc["text"])

    names = F.regexp_extract_all(value, F.lit(step), F.lit(1))
    none = F.array().cast("array<string>")
    out = F.when(value == "", "").when(readable, F.array_join(F.transform(segments, written), "/")).otherwise(F.upper(value))
    classes = F.when((value != "") & readable, F.transform(names, lambda n: F.element_at(kinds, F.upper(n)))).otherwise(none)
    return out, classes, F.when((value == "") | readable, "").otherwise("passage.unread")


def class_of(classes: Column) -> Column:
    """The class of a whole history: egg before cell before original; else unknown."""
    return reduce(lambda rest, kind: F.when(F.array_contains(classes, kind), kind).otherwise(rest), ("original", "cell", "egg"), F.lit("unknown"))


#: Steps that are egg passages when they come last (fixed values).
EGG_STEPS = ("E", "SPFCE", "SPE", "SPF", "D")


def last_step_is_egg(passage: Column) -> Column:
    """Whether the last step is egg, or the text says EGG or EMBRYON; notes in brackets aren't steps."""
    steps = F.regexp_extract_all(F.regexp_replace(F.upper(passage), r"\([^()]*\)", ""), F.lit("[A-Z]+"), F.lit(0))
    said = F.upper(passage).rlike("EGG|EMBRYON")
    return (F.size(steps) > 0) & (F.element_at(steps, -1).isin(*EGG_STEPS) | said)


def loose_steps(passage: Column) -> Column:
    """A passage's (name, count) steps, read from free text, as texts `NAME:count`."""
    found = F.regexp_extract_all(F.upper(passage), F.lit(r"([A-Z]+)\s*(\d+|X|\?)?"), F.lit(0))
    return F.transform(found, lambda s: F.concat(F.regexp_extract(s, "[A-Z]+", 0), F.lit(":"), F.regexp_extract(s, r"[A-Z]+\s*(\d+|X|\?)?$", 1)))


def passage_rank(mine: Column, mine_egg: Column, theirs: Column, theirs_egg: Column) -> Column:
    """How far two passages (loose_steps) are apart: 0 equal, 10 same last step, 20 its name, 50 both or neither egg, else 90."""
    some = (F.size(mine) > 0) & (F.size(theirs) > 0)
    name = lambda steps: F.split_part(F.element_at(steps, -1), F.lit(":"), F.lit(1))
    near = F.when(F.element_at(mine, -1) == F.element_at(theirs, -1), 10).when(name(mine) == name(theirs), 20).when(mine_egg == theirs_egg, 50).otherwise(90)
    return F.when(some & (mine == theirs), 0).when(~some, 90).otherwise(near)


def mature_position(locus: Column, position: Column, nuc_offset: int, ha1_length: int, mature_nt: int) -> tuple[Column, Column, Column]:
    """(alphabet, position in the mature protein or its gene, why there is none) of an upstream locus."""
    at = F.when(locus == "HA2", position + ha1_length).when(locus == "HA1", position).when(locus == "nuc", position - nuc_offset)
    protein = locus.isin("HA1", "HA2")
    reason = (
        F.when(~locus.isin("HA1", "HA2", "SigPep", "nuc"), "unknown locus")
        .when(position < 1, "position before 1")
        .when(locus == "SigPep", "signal peptide precedes the mature protein")
        .when(protein & (at > mature_nt // 3), "residue follows the mature protein")
        .when((locus == "nuc") & (at < 1), "nucleotide precedes the mature protein")
        .when((locus == "nuc") & (at > mature_nt), "nucleotide follows the mature protein")
        .otherwise("")
    )
    return F.when(reason == "", F.when(protein, "aa").otherwise("nuc")), F.when(reason == "", at), reason


MUTATION = r"(?i)^(nuc)?([0-9]+)([A-Z-])$"


def mutations(text: Column) -> tuple[Column, Column]:
    """(positions, unread tokens) of `145S nuc123A`: structs of alphabet, position and state."""
    tokens = F.filter(F.split(text, r"\s+"), lambda t: t != "")
    good = F.filter(tokens, lambda t: t.rlike(MUTATION))
    parts = lambda t: F.struct(
        F.when(F.regexp_extract(t, MUTATION, 1) != "", "nuc").otherwise("aa").alias("alphabet"),
        F.regexp_extract(t, MUTATION, 2).cast("int").alias("position"),
        F.upper(F.regexp_extract(t, MUTATION, 3)).alias("state"),
    )
    return F.transform(good, parts), F.filter(tokens, lambda t: ~t.rlike(MUTATION))


@F.pandas_udf(StringType())
def xxh32_hex(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """xxHash32 of a text's UTF-8 as 8 upper-case hex digits."""
    import xxhash

    for texts in batches:
        yield texts.map(lambda t: xxhash.xxh32_hexdigest(t.encode()).upper(), na_action="ignore")


def canonical_json(fields: Mapping[str, Column]) -> Column:
    """A row as JSON text with its keys in order, no blanks, and NULLs kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def printed_serum_id(serum_id: Column, lab: Column, printing: Column) -> Column:
    """A serum id as maps print it: `with-lab` as stored, `bare` without its own laboratory's code in front."""
    prefix = F.concat(lab, F.lit(" "))
    rest = F.when(F.startswith(serum_id, prefix), F.substr(serum_id, F.length(prefix) + 1)).otherwise(serum_id)
    return F.when(printing == "with-lab", serum_id).when(F.trim(rest) == "", serum_id).otherwise(rest)


def strain_name(name: Column) -> Column:
    """A name in upper case without the subtype in front."""
    return F.regexp_replace(F.upper(F.trim(name)), r"^(A\(H\d+N\d+\)|A\(H\d+\)|B)/", "")


def passage_date(passage: Column) -> Column:
    """The date in brackets that a laboratory appends to a passage."""
    return F.try_to_date(F.nullif(F.regexp_extract(passage, r"\((\d{4}-\d{2}-\d{2})\)", 1), F.lit("")), "yyyy-MM-dd")


def label(name: Column, suffix: Column, abbreviations: Mapping[str, str]) -> Column:
    """A short label `<place>/<yy>-<suffix>`; NULL for a name of under three parts."""
    parts = F.split(strain_name(name), "/")
    place = F.element_at(parts, 1)
    words = F.filter(F.split(place, "[ _-]+"), lambda w: w != "")
    initials = F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")
    short = F.when(F.size(words) > 1, F.upper(initials)).otherwise(F.initcap(F.substring(place, 1, 2)))
    for key, value in abbreviations.items():
        short = F.when(place == key, value).otherwise(short)
    return F.when(F.size(parts) >= 3, F.concat(short, F.lit("/"), F.right(F.element_at(parts, -1), F.lit(2)), F.lit("-"), suffix))


def designation(name: Column, reassortant: Column, annotations: Column, passage: Column) -> Column:
    """A point as a person reads it: its parts that say something, the passage without its date."""
    parts = F.concat(F.array(name, reassortant), annotations, F.array(F.regexp_replace(passage, r" \(\d{4}-\d{2}-\d{2}\)", "")))
    return F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), " ")


#: Characters that LaTeX reads, and how to print them (fixed values).
TEX = {"\\": r"\textbackslash{}", "&": r"\&", "%": r"\%", "$": r"\$", "#": r"\#", "_": r"\_", "{": r"\{", "}": r"\}", "~": r"\textasciitilde{}", "^": r"\^{}"}


def tex_escaped(text: Column) -> Column:
    """A text that LaTeX prints as it is."""
    table = F.create_map(*[F.lit(x) for pair in TEX.items() for x in pair])
    return F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")


def id_number(text: Column) -> Column:
    """The number at the end of an id; ids without one come after all others."""
    tail = F.substring_index(text, "_", -1)
    return F.when(tail.rlike(r"^\d+$"), F.try_to_number(tail, F.lit("999999999999999999")).cast("long")).otherwise(F.lit(1 << 62))


def sequence_identity(covers: Column, inserted: Column, frameshifts: Column, aligned: Column, own_hash: Column) -> Column:
    """What makes two deposits one sequence: the aligned mature gene if nothing was dropped from it, else the raw text's hash."""
    whole = covers & (inserted == 0) & (frameshifts == 0)
    return F.when(whole, F.concat(F.lit("aligned:"), F.sha2(aligned, 256))).otherwise(F.concat(F.lit("raw:"), own_hash))


def minimum_basis(text: Column) -> Column:
    """A minimum column basis as a log: `none` is 0, `1280` is 7."""
    return F.when(text.isin("none", ""), 0.0).otherwise(F.log2(text.cast("double") / 10))


def leaf_key(isolate: Column, accession: Column) -> Column:
    """A leaf's key; NULL if either id is missing."""
    return F.when((isolate != "") & (accession != ""), F.concat_ws("|", isolate, accession))


@F.pandas_udf(StringType())
def leaf_id(keys: pd.Series) -> pd.Series:
    """A leaf's 64-bit id, as 16 hex digits: BLAKE2b of its key."""
    import hashlib

    return keys.map(lambda k: hashlib.blake2b(k.encode(), digest_size=8).hexdigest(), na_action="ignore")


def placeholders(text: Column) -> Column:
    """The names in a template's braces, in order; doubled braces are text."""
    plain = F.regexp_replace(text, r"\{\{|\}\}", "")
    return F.regexp_extract_all(plain, F.lit(r"\{([^{}]*)\}"), F.lit(1))


def filled(text: Column, values: Mapping[str, Column]) -> Column:
    """A template with its placeholders replaced; NULL if one of them has no value."""
    known = F.array(*[F.lit(k) for k in values])
    out = F.replace(F.replace(text, F.lit("{{"), F.lit("\x02")), F.lit("}}"), F.lit("\x03"))
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    out = F.translate(out, "\x02\x03", "{}")
    return F.when(F.size(F.array_except(placeholders(text), known)) == 0, out)
