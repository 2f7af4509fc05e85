"""Columns for censored readings: tokens such as 40, <10, >1280, ~80 and *."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds of a reading; None is missing or malformed.
REGULAR, LESS, MORE, DODGY, MISSING = "num", "lt", "gt", "dodgy", "missing"

TOKEN = r"^([<>~]?)([0-9]+)$"


def kind(token: Column) -> Column:
    """num, lt, gt, dodgy, missing; NULL for a malformed token."""
    clean = F.trim(token)
    mark = F.regexp_extract(clean, TOKEN, 1)
    valid = F.coalesce(clean.rlike(TOKEN) & (F.regexp_extract(clean, TOKEN, 2).try_cast("long") > 0), F.lit(False))
    return (
        F.when(clean.isin("*", ""), MISSING)
        .when(~valid, F.lit(None))
        .when(mark == "<", LESS)
        .when(mark == ">", MORE)
        .when(mark == "~", DODGY)
        .otherwise(REGULAR)
    )


def value(token: Column) -> Column:
    """The number of a well-formed token."""
    clean = F.trim(token)
    return F.when(kind(token).isin(REGULAR, LESS, MORE, DODGY), F.regexp_extract(clean, TOKEN, 2).try_cast("long"))


def log_titre(number: Column) -> Column:
    """log2 of a titre in units of 10."""
    return F.log2(number / F.lit(10.0))


def shifted(kind_: Column, log: Column) -> Column:
    """The log one step down for a less-than reading, one up for a more-than reading."""
    return F.when(kind_ == LESS, log - 1).when(kind_ == MORE, log + 1).otherwise(log)


def whole(x: Column) -> Column:
    """Rounded half up, as a long."""
    return F.floor(x + 0.5).cast("long")
