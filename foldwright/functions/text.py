"""Text parsing and keys as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The pattern decides which texts count as a quantity with a unit.
QUANTITY = r"(\d*)\s*([a-zA-Z]*)"
DECIMAL_QUANTITY = r"(\d+(?:\.\d+)?)\s*([a-zA-Z]*)"

# Grams per unit.
GRAMS = {"kg": 1000, "lbs": 453}

MISSING_TOKEN = "nan"


def quantity(text: Column, decimal: bool = False) -> Column:
    """Leading number of ``text``, null where there is none."""
    pattern, kind = (DECIMAL_QUANTITY, "double") if decimal else (QUANTITY, "bigint")
    return F.regexp_extract(text, pattern, 1).try_cast(kind)


def unit(text: Column, decimal: bool = False) -> Column:
    """Letters after the leading number; empty if there are none."""
    return F.regexp_extract(text, DECIMAL_QUANTITY if decimal else QUANTITY, 2)


def grams(
    text: Column, factors: Mapping[str, float] = GRAMS, decimal: bool = False, strict: bool = False
) -> Column:
    """``text`` as grams; an unlisted unit leaves the number unchanged.

    ``strict`` raises at run time on text without a leading number.
    """
    value, name = quantity(text, decimal), unit(text, decimal)
    if strict:
        problem = F.concat(F.lit("no quantity in: "), F.coalesce(text, F.lit("null")))
        value = F.when(value.isNull(), F.raise_error(problem).cast("bigint")).otherwise(value)
    scaled = reduce(
        lambda branches, item: branches.when(name == item[0], value * F.lit(item[1])),
        list(factors.items())[1:],
        F.when(name == next(iter(factors)), value * F.lit(next(iter(factors.values())))),
    )
    return scaled.otherwise(value)


def interaction_key(*cols: str, separator: str = "_", missing: str = MISSING_TOKEN) -> Column:
    """Values of two or more columns as one text key."""
    if len(cols) < 2:
        raise ValueError("an interaction needs at least two columns")
    return F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in cols])


def joined_digits(a: Column, b: Column, separator: str = "") -> Column:
    """Two numbers as one text; without a separator 1,12 and 11,2 coincide."""
    return F.concat(a.cast("string"), F.lit(separator), b.cast("string"))
