"""Out-of-fold target encoding.

One aggregate per (feature, category, fold) holds the sum and count of every
target. A train row of fold f is encoded from the other folds' sums, a test
row from all of them, so the cost is one scan and two shuffles of aggregated
rows for any number of folds and targets. Decimal targets are summed exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import present
from ..functions.text import interaction_key
from ..workspace import materialise
from .encoders import category, unpivot_categories
from .folds import hash_fold
from .lookup import (
    CHAIN,
    FILES,
    TABLE_BYTES,
    TOTAL_BYTES,
    TableSize,
    attach,
    attach_all,
    broadcastable,
    counted,
    heavy_keys,
    measure_by,
    size_columns,
    size_of,
)
from .persist import load_table, save_table

TEST_FOLD = -1
PRIOR = "__prior__"     # a feature with one category: its encoding is the prior


def interaction_name(cols: Sequence[str]) -> str:
    return "grouping_" + "_and_".join(cols)


@dataclass(frozen=True)
class FittedTarget:
    """Encodings per (feature, category): ``te`` maps each fold to one mean per target.

    Entry -1 is the mean over all folds: it serves rows outside train, and folds
    in which train never had the category. ``priors`` has the mean of the same
    train rows per fold.
    """

    features: tuple[str, ...]
    interactions: tuple[tuple[str, ...], ...]
    targets: tuple[str, ...]
    fold_col: str
    unseen: str | float
    table: DataFrame
    sizes: dict[str, TableSize] = field(hash=False)
    priors: dict[int, tuple[float | None, ...]] = field(hash=False)

    def transform(
        self, df: DataFrame, table_bytes: int = TABLE_BYTES, total_bytes: int = TOTAL_BYTES
    ) -> DataFrame:
        """Add ``<feature>_TE_<target>``.

        Rows with a fold get the encoding without that fold. Rows whose fold is
        null, or all rows where ``df`` has no fold column, get that of all train rows.
        """
        columns = [F.col(f"`{c}`") for c in df.columns]
        has_fold = self.fold_col in df.columns
        fold = F.coalesce(F.col(self.fold_col), F.lit(TEST_FOLD)) if has_fold else F.lit(TEST_FOLD)
        small = broadcastable(self.sizes, table_bytes, total_bytes)
        keys = {interaction_name(i): interaction_key(*i) for i in self.interactions}
        known = self._filled(self.table)

        def category_of(feature: str) -> Column:
            return keys[feature] if feature in keys else category(df, feature)

        def of_fold(means: Column, own: Column) -> Column:
            return F.when(F.map_contains_key(means, own), means[own]).otherwise(means[F.lit(TEST_FOLD)])

        large = [f for f in self.features if f not in small]
        together = len(large) > 1 and not df.isStreaming
        if together:
            df = attach_all(
                df.withColumn("__fold", fold),
                {f: category_of(f) for f in large},
                ["__fold"],
                known.filter(F.col("feature").isin(large)).withColumn("value", F.col("te")),
                {f: f"__te_{f}" for f in large},
                lambda entry: of_fold(entry, F.col("__fold")),
                [self.sizes[f] for f in large],
            )
        alone = [] if together or df.isStreaming else large
        heavy = {f: heavy_keys(df, [category_of(f)]) for f in alone}
        for i, feature in enumerate(f for f in self.features if f in small or not together):
            if i % CHAIN == 0:
                df = counted(df)
            df = attach(
                df,
                known.filter(F.col("feature") == feature),
                [(category_of(feature), "category")],
                {f"__te_{feature}": "te"},
                null_safe=True,
                small=feature in small,
                weight="n",
                total_weight=self.sizes[feature].weight,
                heavy=heavy.get(feature, ()),
            )
        df, fill = counted(df), self._fill(fold)
        made = []
        for feature in self.features:
            value = F.col(f"`__te_{feature}`")
            value = value if together and feature in large else of_fold(value, fold)
            value = value if fill is None else F.coalesce(value, fill)
            made += [F.get(value, F.lit(i)).alias(f"{feature}_TE_{t}") for i, t in enumerate(self.targets)]
        return df.select(*columns, *made)

    def save(self, path: str) -> None:
        about = {k: getattr(self, k) for k in ("features", "interactions", "targets", "fold_col", "unseen")}
        save_table(self.table, {**about, "priors": list(self.priors.items())}, path, ("feature",))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedTarget:
        table, about = load_table(spark, path)
        sizes = measure_by(table, "feature", "n")
        return cls(
            tuple(about["features"]),
            tuple(tuple(i) for i in about["interactions"]),
            tuple(about["targets"]),
            about["fold_col"],
            about["unseen"],
            table,
            {f: sizes.get(f, TableSize(0, 0)) for f in about["features"]},
            {fold: tuple(values) for fold, values in about["priors"]},
        )

    def _fill(self, fold: Column) -> Column | None:
        """Array for a category without encoding; the priors are a literal of one entry per fold."""
        if self.unseen == "null":
            return None
        if self.unseen != "prior":
            return F.array(*[F.lit(float(self.unseen)) for _ in self.targets])
        pairs = [
            part
            for f, values in sorted(self.priors.items())
            for part in (F.lit(f), F.array(*[F.lit(v).cast("double") for v in values]))
        ]
        return F.create_map(*pairs)[fold] if pairs else None

    def _filled(self, table: DataFrame) -> DataFrame:
        if self._fill(F.lit(TEST_FOLD)) is None:
            return table

        def filled(fold: Column, means: Column) -> Column:
            return F.zip_with(means, self._fill(fold), lambda mean, other: F.coalesce(mean, other))

        return table.withColumn("te", F.transform_values("te", filled))


@dataclass(frozen=True)
class TargetState:
    """Sums and counts per (feature, category, fold): what target encodings are made from, and all they need.

    States of parts of the rows merge into the state of all of them, in any
    order: the fold of a row must not depend on the part it came in.
    """

    encoder: TargetEncoder
    table: DataFrame

    def merge(self, *others: TargetState) -> TargetState:
        """The state of the rows of all. One shuffle of aggregated rows; no earlier row is read again."""
        for other in others:
            if other.encoder.about() != self.encoder.about():
                raise ValueError(f"states of different encoders: {self.encoder.about()} and {other.encoder.about()}")
        rows = reduce(DataFrame.unionByName, [other.table for other in others], self.table)
        keys = ("feature", "category", "fold")
        # a sum of decimals is wider than its parts: the state keeps the type of its sums
        added = [F.sum(f.name).cast(f.dataType).alias(f.name) for f in self.table.schema if f.name not in keys]
        return TargetState(self.encoder, materialise(rows.groupBy(*keys).agg(*added), "target-state"))

    def fitted(self) -> FittedTarget:
        """The encoder as fitted on all rows of the state."""
        return self.encoder.fit_sums(self.table)

    def save(self, path: str) -> None:
        save_table(self.table, self.encoder.about(), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TargetState:
        table, about = load_table(spark, path)
        return cls(TargetEncoder(**about), table)


class TargetEncoder:
    """Mean target per category, without the row's own fold.

    ``unseen`` is ``'prior'`` (mean of the train rows the encoding used), ``'null'``
    or a number. With ``inner_folds`` the encoding is the average of the means
    that leave out one inner fold each, over those that saw the category.
    """

    fitted = FittedTarget

    def __init__(
        self,
        cols: Sequence[str],
        targets: Sequence[str],
        interactions: Sequence[Sequence[str]] = (),
        fold_col: str = "fold",
        unseen: str | float = "prior",
        inner_folds: int | None = None,
        row_id: str = "row_id",
        inner_seed: int = 42,
    ):
        if isinstance(unseen, str) and unseen not in ("prior", "null"):
            raise ValueError(f"unseen must be 'prior', 'null' or a number, got {unseen!r}")
        if inner_folds is not None and inner_folds < 2:
            raise ValueError("inner_folds must be at least 2")
        self.cols, self.targets = tuple(cols), tuple(targets)
        self.interactions = tuple(tuple(i) for i in interactions)
        self.fold_col, self.unseen = fold_col, unseen
        self.inner_folds, self.row_id, self.inner_seed = inner_folds, row_id, inner_seed

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.cols, *[interaction_name(i) for i in self.interactions])

    def fit(self, train: DataFrame) -> FittedTarget:
        return self.fit_sums(self._sums(train, self.features))

    def state(self, train: DataFrame) -> TargetState:
        """The stored sums of ``train``, to be merged with those of other rows."""
        return TargetState(self, materialise(self._sums(train, self.features), "target-state"))

    def fit_sums(self, sums: DataFrame) -> FittedTarget:
        """The encodings that follow from sums and counts per (feature, category, fold)."""
        encodings = self._encodings(sums)
        spread = F.pmod(F.xxhash64("category"), F.lit(FILES))
        table = materialise(encodings.repartition("feature", spread), "target-encoder", ("feature",))
        # one row per feature; the prior has one entry per fold
        prior = F.first(F.when(F.col("feature") == PRIOR, F.col("te")), ignorenulls=True)
        told = {
            r["feature"]: r
            for r in table.groupBy("feature").agg(*size_columns(table, "n"), prior.alias("prior")).collect()
        }
        sizes = {f: size_of(told[f]) if f in told else TableSize(0, 0) for f in self.features}
        priors = {fold: tuple(te) for fold, te in (told[PRIOR]["prior"] if PRIOR in told else {}).items()}
        return FittedTarget(
            self.features, self.interactions, self.targets, self.fold_col, self.unseen, table, sizes, priors
        )

    def about(self) -> dict:
        """What the encoder was made with."""
        names = ("cols", "targets", "interactions", "fold_col", "unseen", "inner_folds", "row_id", "inner_seed")
        return {name: getattr(self, name) for name in names}

    def reads(self) -> tuple[str, ...]:
        """The columns that decide a fit."""
        joined = dict.fromkeys((*self.cols, *[c for i in self.interactions for c in i], *self.targets, self.fold_col))
        return (*joined, *([self.row_id] if self.inner_folds and self.row_id not in joined else []))

    def _parts(self) -> range:
        return range(self.inner_folds or 1)

    def _sums(self, train: DataFrame, features: Sequence[str]) -> DataFrame:
        """Sum and count of each target per (feature, category, fold), one pair per inner fold."""
        if self.inner_folds:
            inner = hash_fold(self.row_id, self.inner_folds, self.inner_seed)
        else:
            inner = F.lit(0)
        keys = {interaction_name(i): interaction_key(*i) for i in self.interactions}
        rows = train.select(
            F.col(self.fold_col).alias("fold"),
            inner.alias("inner"),
            *[_number(train, t).alias(f"y_{t}") for t in self.targets],
            *[category(train, c).alias(c) for c in self.cols],
            *[key.alias(name) for name, key in keys.items()],
            F.lit("").alias(PRIOR),
        )
        long = unpivot_categories(
            rows, (*features, PRIOR), ["fold", "inner", *[f"y_{t}" for t in self.targets]]
        )

        def part(target: str, i: int) -> Column:
            value = F.col(f"y_{target}")
            return F.when(F.col("inner") == i, value) if self.inner_folds else value

        return long.groupBy("feature", "category", "fold").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(part(t, i)).alias(f"s_{t}_{i}") for t in self.targets for i in self._parts()],
            *[F.count(part(t, i)).alias(f"c_{t}_{i}") for t in self.targets for i in self._parts()],
        )

    def _encodings(self, sums: DataFrame) -> DataFrame:
        """Per category, the means for each fold left out and for none (fold -1)."""
        whole = Window.partitionBy("feature", "category")
        by_fold = whole.orderBy("fold")
        earlier = by_fold.rowsBetween(Window.unboundedPreceding, -1)
        later = by_fold.rowsBetween(1, Window.unboundedFollowing)
        parts = [f"{kind}_{t}_{i}" for kind in "sc" for t in self.targets for i in self._parts()]
        # the other folds are added up, not subtracted from the total: nothing cancels
        zero = {p: F.lit(0).cast(sums.schema[p].dataType) for p in parts}
        spread = sums.select(
            "feature",
            "category",
            "fold",
            F.sum("n").over(whole).alias("n"),
            *[
                (F.coalesce(F.sum(p).over(earlier), zero[p]) + F.coalesce(F.sum(p).over(later), zero[p])).alias(f"o_{p}")
                for p in parts
            ],
            *[F.sum(p).over(whole).alias(f"a_{p}") for p in parts],
        )

        def means(prefix: str) -> Column:
            return F.array(*[self._mean(prefix, t) for t in self.targets])

        own = F.when(F.col("fold").isNotNull(), F.struct(F.col("fold").cast("int").alias("fold"), means("o").alias("te")))
        # the window has brought a category's rows together already
        return spread.groupBy("feature", "category").agg(
            F.first("n").alias("n"),
            F.map_concat(F.map_from_entries(F.collect_list(own)), F.create_map(F.lit(TEST_FOLD), F.first(means("a")))).alias("te"),
        )

    def _mean(self, prefix: str, target: str) -> Column:
        if not self.inner_folds:
            return _ratio(F.col(f"{prefix}_s_{target}_0"), F.col(f"{prefix}_c_{target}_0"))
        rounds = []
        for i in self._parts():
            kept = [j for j in self._parts() if j != i]
            total = reduce(add, [F.coalesce(F.col(f"{prefix}_s_{target}_{j}"), F.lit(0)) for j in kept])
            number = reduce(add, [F.col(f"{prefix}_c_{target}_{j}") for j in kept])
            rounds.append(_ratio(total, number))
        seen = reduce(add, [r.isNotNull().cast("int") for r in rounds])
        return _ratio(reduce(add, [F.coalesce(r, F.lit(0.0)) for r in rounds]), seen)


def _number(df: DataFrame, column: str) -> Column:
    exact = df.schema[column].dataType.typeName() == "decimal"
    return F.col(column) if exact else present(df, column).cast("double")


def _ratio(total: Column, number: Column) -> Column:
    return F.when(number > 0, total.cast("double") / number.cast("double"))
