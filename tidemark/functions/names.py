"""Columns for strain names, partial dates, keys, sequences and passages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapsed(raw: Column) -> Column:
    """Trimmed, upper case, single spaces, none around slashes."""
    text = F.upper(F.trim(F.regexp_replace(raw, r"\s+", " ")))
    return F.regexp_replace(text, r" ?/ ?", "/")


def without_note(name: Column) -> Column:
    """A name without its trailing parenthesis."""
    return F.trim(F.regexp_replace(name, r"\s*\([^()]*\)$", ""))


def squash(text: Column) -> Column:
    """Letters and digits only, upper case."""
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")


def full_year(digits: Column, collected: Column) -> Column:
    """A four-digit year; two digits take the century that isn't after the collection year."""
    number = digits.cast("int")
    century = collected - F.pmod(collected - number, F.lit(100))
    return F.when(F.length(digits) == 4, number).when((F.length(digits) == 2) & collected.isNotNull(), century)


def isolate(text: Column) -> Column:
    """An isolate number without leading zeros."""
    return F.regexp_replace(text, r"^0+(?=[0-9])", "")


def partial_first(text: Column) -> Column:
    """First day of YYYY, YYYY-MM or YYYY-MM-DD; NULL for anything else."""
    padded = F.when(text.rlike(r"^\d{4}$"), F.concat(text, F.lit("-01-01"))).when(text.rlike(r"^\d{4}-\d{2}$"), F.concat(text, F.lit("-01"))).when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text)
    return F.try_to_date(padded, "yyyy-MM-dd")


def partial_precision(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}$"), "year").when(text.rlike(r"^\d{4}-\d{2}$"), "month").when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), "day")


def partial_last(text: Column) -> Column:
    first, precision = partial_first(text), partial_precision(text)
    return F.when(precision == "year", F.make_date(F.year(first), F.lit(12), F.lit(31))).when(precision == "month", F.last_day(first)).otherwise(first)


def midpoint(first: Column, last: Column) -> Column:
    return F.date_add(first, F.floor(F.datediff(last, first) / 2).cast("int"))


def framed(*parts: Column) -> Column:
    """Several columns as one text that no other values give: each with its length in front; NULL is `-`."""
    texts = [p.cast("string") for p in parts]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def identity(annotations: Column, passage: Column, *parts: Column) -> Column:
    """16 hex digits of the parts' hash; NULL, which equals nothing, for DISTINCT points and empty passages."""
    text = framed(*parts, annotations, passage)
    return F.when((annotations != "DISTINCT") & (passage != ""), F.substring(F.sha2(text, 256), 1, 16))


#: The standard genetic code, codons in the order T, C, A, G of each base.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
BASES = "TCAG"


def translated(nucleotides: Column) -> Column:
    """Codons to amino acids: a whole deletion stays one, anything unknown is X, a partial codon is dropped."""
    codons = F.regexp_extract_all(nucleotides, F.lit("[^.]{3}"), F.lit(0))  # one pass, however long the text is

    def amino(codon: Column) -> Column:
        digit = lambda k: F.instr(F.lit(BASES), F.substr(codon, F.lit(k), F.lit(1))) - 1
        known = codon.rlike("^[ACGT]{3}$")
        return F.when(codon == "---", "-").when(known, F.substr(F.lit(AMINO_ACIDS), digit(1) * 16 + digit(2) * 4 + digit(3) + 1, F.lit(1))).otherwise("X")

    return F.when(F.length(nucleotides) < 3, "").otherwise(F.array_join(F.transform(codons, amino), ""))


def evidence(sequence: Column, position: Column, state: Column, unknown: str = "X", gap_blind: Column | None = None) -> Column:
    """Whether a locus shows a state: equal, contradicts or unobservable."""
    symbol = F.substr(sequence, position, F.lit(1))
    unseen = sequence.isNull() | (position < 1) | (position > F.length(sequence)) | (symbol == unknown)
    if gap_blind is not None:
        unseen = unseen | gap_blind & ((symbol == "-") | (state == "-"))
    return F.when(unseen, "unobservable").when(symbol == state, "equal").otherwise("contradicts")


def p_distance(a: Column, b: Column, called: str = "ACGT", least: float = 0.9) -> Column:
    """Share of differing sites among those called in both; NULL if too few are."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(F.instr(F.lit(called), x).between(1, 99) & F.instr(F.lit(called), y).between(1, 99), (x != y).cast("int")))
    compared = F.filter(pairs, lambda x: x.isNotNull())
    size = F.greatest(F.length(a), F.length(b))
    return F.when((F.size(compared) > 0) & (F.size(compared) >= least * size), F.aggregate(compared, F.lit(0), lambda s, x: s + x) / F.size(compared))


def passage_class(passage: Column) -> Column:
    """egg if any step is, else cell, else original, else unknown."""
    text = F.upper(F.coalesce(passage, F.lit("")))
    return F.when(text.rlike(r"(^|/| )(E|AM|SPFE)[0-9?]*(/| |$)"), "egg").when(text.rlike("MDCK|SIAT|QMC|CELL|^C[0-9X?]"), "cell").when(text.rlike("OR$|ORIGINAL|CLINICAL"), "original").otherwise("unknown")


def passage_score(steps_a: Column, date_a: Column, steps_b: Column, date_b: Column) -> Column:
    """0 for different steps or dates, 2 for equal steps and dates, 1 for equal steps with a date missing."""
    same = steps_a.isNotNull() & (steps_a == steps_b)
    return F.when(~F.coalesce(same, F.lit(False)), 0).when(date_a.isNull() | date_b.isNull(), 1).when(date_a == date_b, 2).otherwise(0)


def wrapped_longitude(longitude: Column, centre: Column) -> Column:
    """A longitude within 180 degrees of the map's centre."""
    return F.pmod(longitude - centre + 180, F.lit(360.0)) - 180 + centre


def natural(text: Column) -> Column:
    """A sort key in which numbers inside a text, however long, count as numbers: their digits follow their number of digits."""
    parts = F.regexp_extract_all(text, F.lit(r"(\d+|\D+)"), F.lit(1))

    def key(part: Column) -> Column:
        digits = F.regexp_replace(part, r"^0+(?=\d)", "")
        return F.when(part.rlike(r"^\d+$"), F.concat(F.lpad(F.length(digits).cast("string"), 9, "0"), digits)).otherwise(part)

    return F.array_join(F.transform(parts, key), "")
