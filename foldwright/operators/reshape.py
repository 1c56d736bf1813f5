"""Union, split, column blocks and fills."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import present

TRAIN, TEST = "train", "test"


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """All rows of both, by column name, tagged ``split``; columns one side lacks are null there."""
    return train.withColumn("split", F.lit(TRAIN)).unionByName(
        test.withColumn("split", F.lit(TEST)), allowMissingColumns=True
    )


def split_train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col("split") == TRAIN), df.filter(F.col("split") == TEST)


def project_features(df: DataFrame, names: Sequence[str], keys: Sequence[str] = ("row_id", "split")) -> DataFrame:
    return df.select(*keys, *names)


def assemble_blocks(blocks: Sequence[DataFrame], keys: Sequence[str] = ("row_id", "split")) -> DataFrame:
    """Feature blocks stored apart, put side by side by key."""
    return reduce(lambda a, b: a.join(b, list(keys), "inner"), blocks)


def map_lookup(text: Column, table: dict[str, object], kind: str) -> Column:
    """Value of ``text`` in a small fixed table, null where not listed."""
    pairs = [F.lit(x) for key, value in table.items() if value is not None for x in (key, value)]
    return F.create_map(*pairs)[text].cast(kind)


def below(least: float | None) -> float:
    """One less, or less by a small share where one is lost in rounding; -1 where there is no number."""
    return -1.0 if least is None else least - max(1.0, abs(least) * 1e-9)


def is_vector(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, VectorUDT)


def fill_below_min(
    df: DataFrame,
    cols: Sequence[str],
    fit_on: DataFrame | None = None,
    least: Mapping[str, float | None] | None = None,
) -> DataFrame:
    """Missing numbers become a value below the column's minimum, so trees see them as the smallest.

    The minima are those of ``fit_on`` (``df`` by default), or ``least`` if they are
    known from an earlier job. Vector columns have no gaps and stay as they are.
    """
    source = fit_on if fit_on is not None else df
    numbers = [c for c in cols if not is_vector(df, c)]
    if least is None:
        floor = source.agg(F.count(F.lit(1)), *[F.min(present(source, c).cast("double")) for c in numbers]).first()  # one row
        least = {c: floor[i + 1] for i, c in enumerate(numbers)}
    return df.withColumns({c: F.coalesce(present(df, c).cast("double"), F.lit(below(least[c]))) for c in numbers})


def rowcount_guard(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before, rows after, repeated keys after, and whether the block kept the rows."""
    sides = after.select(F.lit(1).alias("side"), *keys).unionByName(before.select(F.lit(0).alias("side")), allowMissingColumns=True)
    copies = sides.groupBy("side", *keys).agg(F.count(F.lit(1)).alias("copies"))

    def rows(side: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("copies"))), F.lit(0))

    result = copies.agg(
        rows(0).alias("rows_before"),
        rows(1).alias("rows_after"),
        F.count_if((F.col("side") == 1) & (F.col("copies") > 1)).alias("repeated_keys"),
    )
    ok = (F.col("rows_before") == F.col("rows_after")) & (F.col("repeated_keys") == 0)
    return result.withColumn("kept", ok.cast("int"))
