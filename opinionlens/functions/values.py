"""Small value expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions.text import ColumnOrName, column


def share(part: ColumnOrName, whole: ColumnOrName) -> Column:
    return F.round(column(part) / column(whole), 4)


def safe_divide(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """Unrounded quotient, 0 where the divisor is 0 or null."""
    return F.coalesce(column(part) / F.nullif(column(whole), F.lit(0)), F.lit(0.0))


def orientation(pos: ColumnOrName, neg: ColumnOrName) -> Column:
    """Which side is larger; ties are balanced."""
    pos, neg = column(pos), column(neg)
    return F.when(pos > neg, K.POS).when(neg > pos, K.NEG).otherwise(K.BALANCED)


def lookup(c: ColumnOrName, table: Mapping[str, str]) -> Column:
    """Value of ``c`` in a small literal table, null where it is absent."""
    if not table:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), column(c))


def format_thousands(c: ColumnOrName) -> Column:
    """Whole number with dots between groups of three digits."""
    return F.translate(F.format_number(column(c), 0), ",", ".")


def place_or_unknown(c: ColumnOrName) -> Column:
    trimmed = F.trim(F.coalesce(column(c).cast("string"), F.lit("")))
    return F.when(F.length(trimmed) == 0, K.UNKNOWN_PLACE).otherwise(trimmed)


def label_value(c: ColumnOrName) -> Column:
    """1 / 0 / other whole number from text such as ``1``, ``1.0``; null for anything else."""
    return column(c).cast("string").try_cast("double").try_cast("int")


def date_value(c: ColumnOrName) -> Column:
    return column(c).cast("string").try_cast("date")


def state_from_name(name: ColumnOrName, table: Mapping[str, str] | None = None) -> Column:
    """State of the first key contained in the lower-cased file name, else null."""
    table = K.STATE_BY_FILE_KEY if table is None else table
    name = F.lower(column(name))
    chain: Column | None = None
    for key, state in table.items():
        hit = F.contains(name, F.lit(key))
        chain = F.when(hit, state) if chain is None else chain.when(hit, state)
    return F.lit(None).cast("string") if chain is None else chain


def area(city: ColumnOrName = "city", state: ColumnOrName = "state") -> Column:
    return F.concat(column(city), F.lit(", "), column(state))


def class_counts(label: ColumnOrName = "binary_label") -> list[Column]:
    """Counts of the positive, negative and undecided rows of a group."""
    label = column(label)
    return [
        F.count_if(label == 1).alias("pos"),
        F.count_if(label == 0).alias("neg"),
        F.count_if(label.isNull()).alias("unclear"),
    ]
