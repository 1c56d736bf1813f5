"""Missing-value tokens and types of text input."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts read as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)


def clean_text(value: Column, tokens: Collection[str] = MISSING_TOKENS) -> Column:
    return F.when(~value.isin(*tokens), value)


def typed(value: Column, kind: T.DataType) -> Column:
    """Text as ``kind``, null where it does not parse; whole numbers may carry a fraction of zero."""
    name = kind.typeName()
    if name == "string":
        return value
    if name in ("integer", "long"):
        number = value.try_cast("double")
        whole = F.when(number == F.floor(number), number).try_cast("bigint")
        return F.coalesce(value.try_cast("bigint"), whole).try_cast(kind)
    if name in ("double", "float"):
        number = value.try_cast(kind)
        return F.when(~F.isnan(number), number)
    return value.try_cast(kind)


def normalise_missing(
    df: DataFrame, schema: T.StructType | None = None, tokens: Collection[str] = MISSING_TOKENS
) -> DataFrame:
    """Missing tokens and NaN become null; text columns named in ``schema`` get its types."""
    wanted = {f.name: f.dataType for f in schema} if schema is not None else {}
    out = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if field.dataType.typeName() == "string":
            value = typed(clean_text(value, tokens), wanted.get(field.name, field.dataType))
        elif field.dataType.typeName() in ("double", "float"):
            value = F.when(~F.isnan(value), value)
        out.append(value.alias(field.name))
    return df.select(*out)


def infer_types(texts: DataFrame, tokens: Collection[str] = MISSING_TOKENS) -> T.StructType:
    """Narrowest of bigint, double, boolean and string that fits every value; one aggregate."""
    kinds = (T.LongType(), T.DoubleType(), T.BooleanType())
    checks = []
    for i, c in enumerate(texts.columns):
        value = clean_text(F.col(f"`{c}`"), tokens)
        for j, kind in enumerate(kinds):
            fits = value.try_cast(kind).isNotNull()
            checks.append(F.count_if(value.isNotNull() & ~fits).alias(f"bad_{i}_{j}"))
        checks.append(F.count(value).alias(f"some_{i}"))
    row = texts.agg(*checks).first()
    fields = []
    for i, c in enumerate(texts.columns):
        fitting = [k for j, k in enumerate(kinds) if row[f"bad_{i}_{j}"] == 0]
        # a column without any value reads as a number column without numbers
        kind = T.DoubleType() if row[f"some_{i}"] == 0 else (fitting[0] if fitting else T.StringType())
        fields.append(T.StructField(c, kind))
    return T.StructType(fields)
