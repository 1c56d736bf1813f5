"""Ordinal, count and one-hot encoding, fitted on train rows and applied by join.

All columns of one encoder are fitted by a single scan and a single shuffle
of per-category aggregates: the columns are unpivoted to (feature, category).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import present
from .lookup import (
    CHAIN,
    TABLE_BYTES,
    TOTAL_BYTES,
    TableSize,
    attach,
    attach_all,
    broadcastable,
    counted,
    heavy_keys,
    measure_by,
    store_by,
)
from .persist import load_table, save_table
from .running import ROWS_PER_TASK, running_total

UNKNOWN = -1
MISSING_UNSEEN = -2
COLUMNS, VECTORS = "columns", "vectors"


def is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("string", "char", "varchar")


def split_numeric(df: DataFrame, cols: Sequence[str], numeric: str) -> tuple[list[str], list[str]]:
    """Columns to encode, and columns to pass through when ``numeric='passthrough'``."""
    if numeric not in ("encode", "passthrough"):
        raise ValueError(f"numeric must be 'encode' or 'passthrough', got {numeric!r}")
    if numeric == "encode":
        return list(cols), []
    texts = [c for c in cols if is_text(df, c)]
    return texts, [c for c in cols if c not in texts]


def category(df: DataFrame, column: str) -> Column:
    """The value as text; NaN is missing."""
    return present(df, column).cast("string")


def unpivot_categories(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column): ``feature``, ``category`` as text, and the ``keep`` columns."""
    ids = [f"__id_{k}" for k in keep]
    long = df.select(
        *[F.col(k).alias(i) for k, i in zip(keep, ids)], *[category(df, c).alias(c) for c in cols]
    ).unpivot(ids, list(cols), "feature", "category")
    return long.select(*[F.col(i).alias(k) for k, i in zip(keep, ids)], "feature", "category")


def _complete(sizes: dict[str, TableSize], features: Sequence[str]) -> dict[str, TableSize]:
    """A feature fitted on no rows has no category."""
    return {f: sizes.get(f, TableSize(0, 0)) for f in features}


@dataclass(frozen=True)
class FittedEncoder:
    """Per-category values of several columns in one table (``feature``, ``category``, ``n``, values)."""

    encoded: tuple[str, ...]
    passthrough: tuple[str, ...]
    order: tuple[str, ...]
    table: DataFrame
    sizes: dict[str, TableSize] = field(hash=False)

    described: ClassVar[tuple[str, ...]] = ("encoded", "passthrough", "order")

    def _attach_all(
        self, df: DataFrame, value: str, out: str, table_bytes: int, total_bytes: int
    ) -> DataFrame:
        small = broadcastable(self.sizes, table_bytes, total_bytes)
        large = [c for c in self.encoded if c not in small]
        if len(large) > 1 and not df.isStreaming:
            entries = self.table.filter(F.col("feature").isin(large)).withColumn("value", F.col(value))
            texts = {c: category(df, c) for c in large}
            sizes = [self.sizes[c] for c in large]
            df = attach_all(df, texts, [], entries, {c: out.format(c) for c in large}, lambda entry: entry, sizes)
            large = []
        # one large column: its values in the rows are read once before the joins are planned
        heavy = {c: heavy_keys(df, [category(df, c)]) for c in large if not df.isStreaming}
        for i, column in enumerate(c for c in self.encoded if c in small or c in large):
            if i % CHAIN == 0:
                df = counted(df)
            rows = self.table.filter(F.col("feature") == column)
            df = attach(
                df,
                rows,
                [(category(df, column), "category")],
                {out.format(column): value},
                null_safe=True,
                small=column in small,
                weight="n",
                total_weight=self.sizes[column].weight,
                heavy=heavy.get(column, ()),
            )
        return df

    def _with(self, df: DataFrame, columns: Sequence[str], made: dict[str, Column]) -> DataFrame:
        return df.select(
            *[F.col(f"`{c}`") for c in columns], *[made[c].alias(c + self.suffix) for c in self.order]
        )

    def save(self, path: str) -> None:
        """Store the fitted table and its description under ``path``."""
        about = {name: getattr(self, name) for name in self.described}
        save_table(self.table, about, path, ("feature",))

    def _united(self, others: Sequence[FittedEncoder]) -> DataFrame:
        """The rows of several fitted tables of the same columns."""
        for other in others:
            if (type(other), other.order, other.encoded) != (type(self), self.order, self.encoded):
                raise ValueError("fits of different encoders cannot be merged")
        return reduce(DataFrame.unionByName, [other.table for other in others], self.table)

    @classmethod
    def load(cls, spark: SparkSession, path: str):
        table, about = load_table(spark, path)
        names = {k: v if isinstance(v, str) else tuple(v) for k, v in about.items()}
        return cls(**names, table=table, sizes=_complete(measure_by(table, "feature", "n"), names["encoded"]))


class FittedCount(FittedEncoder):
    suffix = "_CE"

    def merge(self, *others: FittedCount) -> FittedCount:
        """As fitted on the rows of all."""
        counts = self._united(others).groupBy("feature", "category").agg(F.sum("n").alias("n"))
        table, sizes = store_by(counts, "count-encoder", "feature", "n")
        return FittedCount(self.encoded, self.passthrough, self.order, table, _complete(sizes, self.encoded))

    def transform(
        self, df: DataFrame, table_bytes: int = TABLE_BYTES, total_bytes: int = TOTAL_BYTES
    ) -> DataFrame:
        """Add ``<col>_CE``: the category's train frequency, -1 if unseen."""
        columns = df.columns
        df = self._attach_all(df, "n", "__n_{}", table_bytes, total_bytes)
        made = {c: F.coalesce(F.col(f"`__n_{c}`"), F.lit(UNKNOWN)).cast("bigint") for c in self.encoded}
        made |= {c: F.col(c) for c in self.passthrough}
        return self._with(df, columns, made)


class CountEncoder:
    """Train frequency of each category; a missing value counts as a category."""

    fitted = FittedCount

    def __init__(self, cols: Sequence[str], numeric: str = "encode"):
        self.cols, self.numeric = tuple(cols), numeric

    def about(self) -> dict:
        """What the encoder was made with."""
        return {"cols": self.cols, "numeric": self.numeric}

    def reads(self) -> tuple[str, ...]:
        """The columns that decide a fit."""
        return self.cols

    def fit(self, train: DataFrame) -> FittedCount:
        encoded, passthrough = split_numeric(train, self.cols, self.numeric)
        counts = unpivot_categories(train, encoded).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))
        table, sizes = store_by(counts, "count-encoder", "feature", "n")
        return FittedCount(tuple(encoded), tuple(passthrough), self.cols, table, _complete(sizes, encoded))


class FittedOrdinal(FittedEncoder):
    suffix = "_OE"

    def merge(self, *others: FittedOrdinal, rows_per_task: int = ROWS_PER_TASK) -> FittedOrdinal:
        """As fitted on the rows of all: codes follow the row in which any of them first shows a category."""
        first = self._united(others).groupBy("feature", "category").agg(F.sum("n").alias("n"), F.min("first_row").alias("first_row"))
        return replace(self, **_coded(first, self.encoded, rows_per_task))

    def transform(
        self, df: DataFrame, table_bytes: int = TABLE_BYTES, total_bytes: int = TOTAL_BYTES
    ) -> DataFrame:
        """Add ``<col>_OE``: code by first appearance, -1 unknown, -2 missing that train never had."""
        columns = df.columns
        df = self._attach_all(df, "code", "__o_{}", table_bytes, total_bytes)
        made: dict[str, Column] = {}
        for c in self.encoded:
            unseen = F.when(category(df, c).isNull(), F.lit(MISSING_UNSEEN)).otherwise(F.lit(UNKNOWN))
            made[c] = F.coalesce(F.col(f"`__o_{c}`"), unseen).cast("bigint")
        made |= {c: F.col(c) for c in self.passthrough}
        return self._with(df, columns, made)


class OrdinalEncoder:
    """Codes 1..n in the order in which train rows (by ``row_id``) first show a category."""

    fitted = FittedOrdinal

    def __init__(
        self,
        cols: Sequence[str],
        row_id: str = "row_id",
        numeric: str = "encode",
        rows_per_task: int = ROWS_PER_TASK,
    ):
        self.cols, self.row_id, self.numeric, self.rows_per_task = tuple(cols), row_id, numeric, rows_per_task

    def about(self) -> dict:
        """What the encoder was made with."""
        return {"cols": self.cols, "row_id": self.row_id, "numeric": self.numeric}

    def reads(self) -> tuple[str, ...]:
        """The columns that decide a fit."""
        return (*self.cols, self.row_id)

    def fit(self, train: DataFrame) -> FittedOrdinal:
        encoded, passthrough = split_numeric(train, self.cols, self.numeric)
        first = (
            unpivot_categories(train, encoded, [self.row_id])
            .groupBy("feature", "category")
            .agg(F.count(F.lit(1)).alias("n"), F.min(self.row_id).alias("first_row"))
        )
        return FittedOrdinal(tuple(encoded), tuple(passthrough), self.cols, **_coded(first, encoded, self.rows_per_task))


def _coded(first: DataFrame, encoded: Sequence[str], rows_per_task: int) -> dict:
    """The stored categories with codes in the order of ``first_row``, and their sizes."""
    seen, sizes = store_by(first, "first-seen", "feature", "n")
    rows = sum(s.rows for s in sizes.values())
    ranked = running_total(seen, ["feature"], ["first_row"], None, "code", rows, rows_per_task)
    table, _ = store_by(ranked, "ordinal-encoder", "feature", "n")
    return {"table": table, "sizes": _complete(sizes, encoded)}


@dataclass(frozen=True)
class FittedOneHot(FittedOrdinal):
    form: str = COLUMNS

    suffix: ClassVar[str] = "_OHE"
    described: ClassVar[tuple[str, ...]] = (*FittedEncoder.described, "form")

    def categories(self) -> dict[str, list[str | None]]:
        """Train categories per column in code order, on the driver: the names of the columns to make."""
        listed: dict[str, list[str | None]] = {c: [] for c in self.encoded}
        for row in self.table.select("feature", "category", "code").orderBy("feature", "code").collect():
            listed[row["feature"]].append(row["category"])
        return listed

    def transform(
        self, df: DataFrame, table_bytes: int = TABLE_BYTES, total_bytes: int = TOTAL_BYTES
    ) -> DataFrame:
        """Add the encoding in the form the encoder was made with; unknown gives all zeros."""
        return self.vectors(df, table_bytes, total_bytes) if self.form == VECTORS else self.columns(df)

    def columns(self, df: DataFrame) -> DataFrame:
        """Add one 0/1 column per train category, ``<col>_<category>_OHE``."""
        listed = self.categories()
        made: dict[str, Column] = {}
        for c in self.order:
            if c in self.passthrough:
                made[c + self.suffix] = F.col(c)
                continue
            for value in listed[c]:
                label = "nan" if value is None else value
                hit = category(df, c).eqNullSafe(F.lit(value).cast("string"))
                made[f"{c}_{label}{self.suffix}"] = hit.cast("int")
        return df.withColumns(made)

    def vectors(
        self, df: DataFrame, table_bytes: int = TABLE_BYTES, total_bytes: int = TOTAL_BYTES
    ) -> DataFrame:
        """Add one sparse 0/1 vector per column, ``<col>_OHE``, for any number of categories: nothing is collected."""
        from pyspark.ml.feature import OneHotEncoder as IndexVectors

        columns = df.columns
        df = self._attach_all(df, "code", "__o_{}", table_bytes, total_bytes)
        for c in self.encoded:
            last = self.sizes[c].rows
            index = f"__i_{c}"
            # the index after the last code is the invalid one: an all-zero vector
            df = df.withColumn(index, F.coalesce(F.col(f"`__o_{c}`") - 1, F.lit(last)).cast("double"))
            codes = self.table.filter(F.col("feature") == c).select((F.col("code") - 1).cast("double").alias(index))
            stage = IndexVectors(
                inputCols=[index], outputCols=[c + self.suffix], handleInvalid="keep", dropLast=True
            )
            df = stage.fit(codes).transform(df)
        made = {c: F.col(f"`{c}{self.suffix}`") for c in self.encoded} | {c: F.col(c) for c in self.passthrough}
        return self._with(df, columns, made)


class OneHotEncoder:
    """0/1 per train category in order of first appearance: ``form`` says as columns or as one sparse vector."""

    fitted = FittedOneHot

    def __init__(
        self,
        cols: Sequence[str],
        row_id: str = "row_id",
        numeric: str = "encode",
        form: str = COLUMNS,
        rows_per_task: int = ROWS_PER_TASK,
    ):
        if form not in (COLUMNS, VECTORS):
            raise ValueError(f"form must be {COLUMNS!r} or {VECTORS!r}, got {form!r}")
        self._ordinal = OrdinalEncoder(cols, row_id, numeric, rows_per_task)
        self.form = form

    def about(self) -> dict:
        """What the encoder was made with."""
        return {**self._ordinal.about(), "form": self.form}

    def reads(self) -> tuple[str, ...]:
        """The columns that decide a fit."""
        return self._ordinal.reads()

    def fit(self, train: DataFrame) -> FittedOneHot:
        fitted = self._ordinal.fit(train)
        return FittedOneHot(fitted.encoded, fitted.passthrough, fitted.order, fitted.table, fitted.sizes, self.form)
