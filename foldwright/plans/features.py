"""The configured feature table: encoders first, then blocks that may use them.

Every block adds columns to the same rows, so nothing is put together by
position and no block is joined back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import present
from ..operators.encoders import CountEncoder, OneHotEncoder, OrdinalEncoder
from ..operators.folds import group_kfold
from ..operators.group_stats import GroupStats
from ..operators.persist import load_table, save_about
from ..operators.reshape import TRAIN, is_vector
from ..operators.target_encoding import TargetEncoder
from ..workspace import fresh_path, materialise
from .config import Experiment
from .fits import FitStore, fingerprints
from .preprocess import run_steps
from .presets import PROJECTIONS

Transform = Callable[[DataFrame], DataFrame]
# (experiment, train rows) -> transform fitted on them
Fit = Callable[[Experiment, DataFrame], Transform]
# experiment -> encoder, to be fitted or found fitted
Make = Callable[[Experiment], CountEncoder | OrdinalEncoder | OneHotEncoder | TargetEncoder]
ENCODERS: dict[str, Make] = {}
BLOCKS: dict[str, Fit] = {}


def encoder(name: str) -> Callable[[Make], Make]:
    """Register an encoder that is fitted in the first phase, on the cleaned columns."""

    def register(function: Make) -> Make:
        ENCODERS[name] = function
        return function

    return register


def block(name: str) -> Callable[[Fit], Fit]:
    """Register a fit that runs after the encoders and may use their columns."""

    def register(function: Fit) -> Fit:
        BLOCKS[name] = function
        return function

    return register


def train_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == TRAIN)


@encoder("get_ordinal_encoding_features")
def _ordinal(spec: Experiment) -> OrdinalEncoder:
    return OrdinalEncoder(spec.ordinal_cols, spec.row_id, spec.numeric)


@encoder("get_count_encoding_features")
def _count(spec: Experiment) -> CountEncoder:
    return CountEncoder(spec.count_cols, spec.numeric)


@encoder("get_onehot_encoding_features")
def _onehot(spec: Experiment) -> OneHotEncoder:
    return OneHotEncoder(spec.onehot_cols, spec.row_id, spec.numeric, spec.onehot_form)


@encoder("get_target_encoding_features")
def _target(spec: Experiment) -> TargetEncoder:
    te = spec.target_encoding
    return TargetEncoder(te.cols, spec.targets, te.interactions, "fold", te.unseen, te.inner_folds, spec.row_id, te.inner_seed)


def _statistics(name: str) -> Fit:
    def fit(spec: Experiment, train: DataFrame) -> Transform:
        agg = spec.aggregations[name]
        return GroupStats(agg.cat_cols, agg.target_cols, agg.methods).fit(train).transform

    return fit


STATISTICS = ("get_agg_region_features", "get_agg_company_features")
for _name in STATISTICS:
    BLOCKS[_name] = _statistics(_name)


@dataclass(frozen=True)
class FeatureTable:
    """Rows with key, ``split``, ``fold`` (null in test), targets and feature columns.

    A stored table also knows the train minima of its number features, ``least``.
    """

    rows: DataFrame
    features: tuple[str, ...]
    targets: tuple[str, ...]
    row_id: str = "row_id"
    least: Mapping[str, float | None] | None = None

    def save(self, path: str, expected: int | None = None) -> FeatureTable:
        """Write the table by one job and give the stored one.

        The job itself counts the rows and finds the minima. A number of rows other
        than ``expected`` means that a block did not keep them, and raises.
        """
        seen = Observation("features")
        numbers = [f for f in self.features if not is_vector(self.rows, f)]
        least = [F.min(F.when(F.col("split") == TRAIN, present(self.rows, f).cast("double"))) for f in numbers]
        counted = self.rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(f"m_{i}") for i, m in enumerate(least)])
        counted.write.mode("overwrite").partitionBy("split").parquet(f"{path}/table")
        told = seen.get
        if expected is not None and told["rows"] != expected:
            raise ValueError(f"feature blocks changed the number of rows: {expected} before, {told['rows']} after")
        found = {f: told[f"m_{i}"] for i, f in enumerate(numbers)}
        about = {"features": self.features, "targets": self.targets, "row_id": self.row_id, "least": found}
        save_about(self.rows, about, path)
        return FeatureTable.load(self.rows.sparkSession, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureTable:
        rows, about = load_table(spark, path)
        return cls(rows, tuple(about["features"]), tuple(about["targets"]), about["row_id"], about["least"])


def check_features(spec: Experiment, columns: Sequence[str]) -> None:
    """Unknown names and inputs that nothing makes fail here, before any job."""
    unknown = [n for n in spec.features if n not in ENCODERS and n not in BLOCKS and n not in PROJECTIONS]
    if unknown:
        raise ValueError(f"unknown features {unknown}; known: {sorted([*ENCODERS, *BLOCKS, *PROJECTIONS])}")
    available = set(columns)
    if "get_ordinal_encoding_features" in spec.features:
        available |= {f"{c}_OE" for c in spec.ordinal_cols}
    if "get_count_encoding_features" in spec.features:
        available |= {f"{c}_CE" for c in spec.count_cols}
    for name in spec.features:
        needs = PROJECTIONS.get(name, ())
        if name in BLOCKS and name in spec.aggregations:
            needs = (*spec.aggregations[name].cat_cols, *spec.aggregations[name].target_cols)
        lacking = [c for c in needs if c not in available]
        if lacking:
            raise ValueError(f"{name} needs columns {lacking}; add the step or encoder that makes them")


def read_columns(spec: Experiment, columns: Sequence[str]) -> list[str]:
    """Those of the cleaned ``columns`` that folds and features read; all, where a block is not known by what it reads."""
    wanted = {spec.row_id, "split", spec.split.group_col, *spec.targets}
    for name in spec.features:
        agg = spec.aggregations.get(name)
        if name in ENCODERS:
            wanted |= {*ENCODERS[name](spec).reads()}
        elif name in PROJECTIONS:
            wanted |= {*PROJECTIONS[name]}
        elif name in STATISTICS and agg:
            wanted |= {*agg.cat_cols, *agg.target_cols}
        else:
            return list(columns)
    lower = {c.lower() for c in wanted}
    return [c for c in columns if c.lower() in lower]


def build_features(spec: Experiment, rows: DataFrame, fits: FitStore | None = None) -> FeatureTable:
    """Feature table of cleaned rows that carry ``split`` and ``fold``, columns in configured order.

    With ``fits``, encoders that an experiment has fitted on the same values are read from there.
    """
    check_features(spec, rows.columns)
    source, names = rows, []
    made: list[tuple[set[str], Transform]] = []

    def apply(transform: Transform) -> None:
        nonlocal rows
        before = rows.columns
        rows = transform(rows)
        added = [c for c in rows.columns if c not in before]
        names.extend(added)
        made.append((set(added), transform))

    # encoders are fitted on the source columns alone, so no fit repeats another one's joins
    encoders, train = [ENCODERS[n](spec) for n in spec.features if n in ENCODERS], train_rows(source)
    digests = fingerprints(train, spec.row_id, [c for e in encoders for c in e.reads()]) if fits else {}
    for made_with in encoders:
        apply((fits.fit(made_with, train, digests) if fits else made_with.fit(train)).transform)
    for name in [n for n in spec.features if n not in ENCODERS]:
        if name in PROJECTIONS:
            names.extend(c for c in PROJECTIONS[name] if c not in names)
            continue
        agg = spec.aggregations.get(name)
        wanted = {*agg.cat_cols, *agg.target_cols} if agg else set(rows.columns)
        needed = [t for added, t in made if added & wanted]
        apply(BLOCKS[name](spec, reduce(lambda df, t: t(df), needed, train_rows(source))))
    kept = rows.select(spec.row_id, "split", "fold", *[F.col(f"`{c}`") for c in (*spec.targets, *names)])
    return FeatureTable(kept, tuple(names), spec.targets, spec.row_id)


def with_folds(spec: Experiment, rows: DataFrame) -> DataFrame:
    """Add ``fold`` to train rows by group and store the rows; test rows get null."""
    return _stored_with_folds(spec, rows)[0]


def _stored_with_folds(spec: Experiment, rows: DataFrame) -> tuple[DataFrame, int]:
    """The cleaned rows with their folds, written once for all fits, and their number."""
    split, seen = spec.split, Observation("source")
    folds = group_kfold(train_rows(rows), split.group_col, split.n_splits, split.shuffle, split.seed)
    placed = folds.transform(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
    stored = materialise(placed.withColumn("fold", F.when(F.col("split") == TRAIN, F.col("fold"))), "folded")
    return stored, seen.get["rows"]


def feature_table(spec: Experiment, rows: DataFrame, path: str | None = None, fits: FitStore | None = None) -> FeatureTable:
    """Raw united rows to a stored feature table: cleaning, folds, encoders, blocks.

    The source is read twice, for the groups and for the one copy with folds that
    everything after reads, of the columns it reads. The table goes to ``path``, or to the shared folder.
    """
    cleaned = run_steps(rows, spec.preprocess)
    stored, number = _stored_with_folds(spec, cleaned.select(*[F.col(f"`{c}`") for c in read_columns(spec, cleaned.columns)]))
    return build_features(spec, stored, fits).save(path or fresh_path(rows.sparkSession, "feature-table"), number)
