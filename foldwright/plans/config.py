"""Immutable descriptions of an experiment."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from types import MappingProxyType


@dataclass(frozen=True)
class Split:
    group_col: str
    n_splits: int = 5
    shuffle: bool = True
    seed: int = 1234


@dataclass(frozen=True)
class TargetEncoding:
    cols: tuple[str, ...] = ()
    interactions: tuple[tuple[str, ...], ...] = ()
    unseen: str | float = "prior"
    inner_folds: int | None = None
    inner_seed: int = 42


@dataclass(frozen=True)
class Aggregation:
    cat_cols: tuple[str, ...]
    target_cols: tuple[str, ...]
    methods: tuple[str, ...]


@dataclass(frozen=True)
class Learner:
    """``name`` picks the estimator; ``stop`` is None, 'tolerance' or 'patience'."""

    name: str = "gbt"
    params: Mapping[str, object] = field(default_factory=lambda: MappingProxyType({}))
    stop: str | None = "patience"
    patience: int = 100
    parallelism: int = 4


@dataclass(frozen=True)
class Experiment:
    name: str
    targets: tuple[str, ...]
    split: Split
    seeds: tuple[int, ...] = (0, 1)
    metric: str = "mean_absolute_error"
    preprocess: tuple[str, ...] = ()
    features: tuple[str, ...] = ()
    count_cols: tuple[str, ...] = ()
    ordinal_cols: tuple[str, ...] = ()
    onehot_cols: tuple[str, ...] = ()
    onehot_form: str = "columns"
    target_encoding: TargetEncoding = TargetEncoding()
    aggregations: Mapping[str, Aggregation] = field(default_factory=lambda: MappingProxyType({}))
    numeric: str = "encode"
    row_id: str = "row_id"
    learner: Learner = Learner()

    def change(self, **parts: object) -> Experiment:
        return replace(self, **parts)
