"""Boosting of all targets, seeds and folds together, on histograms that passes over the rows fill.

The features are cut into bins once, at all thresholds that any model may split at, and
stored as small whole numbers. The first split of every model follows from one pass,
whatever the number of targets, seeds and folds: a fold's rows are summed up per bin and
target, and a model adds up the folds that it is trained on. Later levels and rounds take a pass each for all
models that still run, with a histogram per model. Tasks send histograms, not rows; the best split of a
feature is found where its histograms meet, so the driver hears of one split per model and node.

Splits are those of ``pyspark.ml``'s trees: thresholds between the values of a sample by seed
(all rows if they are few), the largest drop in variance, and the first feature where several are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import materialise
from .boosting import LOSSES, STORED_EVERY, best_round
from .linear import _matrix
from .reshape import is_vector

#: What a shared pass knows of a learner's parameters, with their defaults; others are left to Spark's learner.
PARAMS = {"maxIter": 20, "stepSize": 0.1, "lossType": "squared", "maxDepth": 5, "maxBins": 32, "minInstancesPerNode": 1, "minInfoGain": 0.0}
#: Rows that a task looks at together.
CHUNK = 16_384
#: Histograms that a task fills in one pass; more nodes take more passes.
HISTOGRAM_BYTES = 64 << 20
#: Models that a row carries the predictions of; more targets go one group after the other.
MOST_MODELS = 128
#: Rows in whose values thresholds are looked for, as in Spark's learner: so many, or the square of the bins.
SAMPLED = 10_000

#: loss -> (what the next tree is fitted on, error of a row), as ``boosting.LOSSES`` on arrays
ON_ARRAYS: dict[str, tuple[Callable, Callable]] = {
    "squared": (lambda y, p: 2.0 * (y - p), lambda y, p: (y - p) * (y - p)),
    "absolute": (lambda y, p: np.where(y - p < 0, -1.0, 1.0), lambda y, p: np.abs(y - p)),
}
_SPLIT = "unit int, slot int, feature int, cut int, gain double, left_n double, left_s double, n double, s double"


def only_numbers(table: DataFrame) -> bool:
    """Whether the features are all stated to be numbers: of categories, Spark's trees split sets."""
    return set(table.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})) == {"numeric"}


def _values(table: DataFrame) -> Column:
    return vector_to_array("features") if is_vector(table, "features") else F.col("features")


@dataclass
class Tree:
    """Nodes in the order they were made, the root first; the children of one stand at ``left`` and behind it."""

    feature: list[int] = field(default_factory=list)  # -1 in a leaf
    cut: list[int] = field(default_factory=list)      # bins up to this one go left
    left: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    count: list[float] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, count: float, total: float) -> int:
        for parts, part in zip((self.feature, self.cut, self.left, self.gain, self.count, self.value), (-1, -1, -1, 0.0, count, total / count)):
            parts.append(part)
        return len(self.feature) - 1

    def split(self, node: int, best) -> list[int]:
        """Give ``node`` the split ``best``; the new nodes."""
        self.feature[node], self.cut[node], self.gain[node] = best.feature, best.cut, best.gain
        self.left[node] = self.add(best.left_n, best.left_s)
        return [self.left[node], self.add(best.n - best.left_n, best.s - best.left_s)]

    def place(self, codes: np.ndarray) -> np.ndarray:
        """The node that each row ends in."""
        if not self.feature or self.feature[0] < 0:
            return np.zeros(len(codes), np.intp)
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        node, rows = left[0] + (codes[:, feature[0]] > cut[0]), np.arange(len(codes))
        while (inner := feature[node] >= 0).any():
            node = np.where(inner, left[node] + (codes[rows, feature[node]] > cut[node]), node)
        return node

    def predict(self, codes: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.place(codes)]

    def spread(self) -> float:
        """Variance of the predictions on the rows that it was fitted on."""
        leaves = [(n, v) for f, n, v in zip(self.feature, self.count, self.value) if f < 0]
        n, v = np.array(leaves).T
        return float((n * (v - (n * v).sum() / n.sum()) ** 2).sum() / n.sum())

    def importances(self, width: int) -> np.ndarray:
        """Per feature, its share of what the splits took from the variance."""
        total = np.zeros(width)
        for f, gain, n in zip(self.feature, self.gain, self.count):
            if f >= 0:
                total[f] += gain * n
        return total / total.sum() if total.sum() > 0 else total


@dataclass
class Grown:
    """A boosted model: its trees by round (the first counts whole, the later ones by ``step``) and its held-out errors."""

    target: int
    seed: int
    fold: int
    number: int  # its place among those of its target
    step: float
    width: int
    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    rounds: int = 0

    def weighted(self, start: int, end: int | None = None) -> list[tuple[float, Tree]]:
        return [(self.step if i else 1.0, self.trees[i]) for i in range(start, len(self.trees) if end is None else end)]

    def importances(self) -> np.ndarray:
        """Per feature, the shares of the trees' splits, each tree weighing as much as its splits explain, brought to the sum 1."""
        total = np.sum([tree.spread() * tree.importances(self.width) for tree in self.trees[: self.rounds]], axis=0)
        return total / total.sum() if total.sum() > 0 else total


@dataclass(frozen=True)
class Bins:
    """Per feature, all thresholds; per model of a target and feature, the places of its own ones among them."""

    cuts: list[np.ndarray]
    own: list[list[np.ndarray]]

    @property
    def kind(self) -> np.dtype:
        return np.min_scalar_type(max(len(c) for c in self.cuts))

    def own_bins(self, number: int, feature: int) -> np.ndarray:
        """The bin among a model's own for each of all bins."""
        return np.searchsorted(self.own[number][feature], np.arange(len(self.cuts[feature]) + 1))


@dataclass(frozen=True)
class Rows:
    """Stored rows: row_id, fold, ``codes`` (a bin for each feature) and ``y``, as bytes; after ``rounds`` rounds also
    ``now`` and ``best``, the predictions of all models then and at their best round."""

    table: DataFrame
    bins: Bins
    targets: int
    models: int
    rounds: int = 0

    def chunks(self) -> Callable[[Iterable[pa.RecordBatch]], Iterator[tuple]]:
        """What gives (row ids, fold, codes, y, now, best) in arrays of up to ``CHUNK`` rows; the last two with no columns before they are stored."""
        kinds = [(self.bins.kind, len(self.bins.cuts)), (np.dtype(float), self.targets)]
        kinds += [(np.dtype(float), self.models)] * 2 if self.rounds else []

        def joined(held: list[pa.RecordBatch]) -> tuple:
            ids = pa.concat_arrays([b.column(0) for b in held])
            fold = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in held])
            parts = [np.concatenate([_from_bytes(b.column(i + 2), *kind) for b in held]) for i, kind in enumerate(kinds)]
            return ids, fold, *parts, *[np.empty((len(fold), 0))] * (4 - len(parts))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
            held, number = [], 0
            for batch in batches:
                if held and number + len(batch) > CHUNK:
                    yield joined(held)
                    held, number = [], 0
                if len(batch):
                    held, number = [*held, batch], number + len(batch)
            if held:
                yield joined(held)

        return run


def _to_bytes(rows: np.ndarray) -> pa.Array:
    """A binary value for each row of a matrix."""
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)]).cast(pa.binary())


def _from_bytes(column: pa.Array, kind: np.dtype, width: int) -> np.ndarray:
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset]
    return np.frombuffer(data, np.uint8, len(column) * width * kind.itemsize, first).view(kind).reshape(len(column), width)


def thresholds(values: np.ndarray, most_bins: int) -> np.ndarray:
    """Middles between neighbouring values: all, or those nearest to equal shares of the rows."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) < most_bins:
        return middles
    stride, chosen = len(values) / most_bins, []
    wanted, passed = stride, counts.cumsum().tolist()
    for i, middle in enumerate(middles.tolist()):
        if abs(passed[i] - wanted) < abs(passed[i + 1] - wanted):
            chosen.append(middle)
            wanted += stride
    return np.array(chosen)


def _uniform(seed: int, columns: Sequence[str]) -> Column:
    """A number from 0 to 1 that follows from the seed and the row."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) * F.lit(2.0**-53)


def _bins(table: DataFrame, targets: Sequence[str], models: Sequence[tuple[int, int]], sizes: Mapping[int, int], width: int, most_bins: int) -> Bins:
    """Thresholds for each (seed, fold), from a sample of the rows of its other folds: one pass."""
    numbers = [sum(n for f, n in sizes.items() if f != fold) for _, fold in models]
    shares = [min(1.0, max(SAMPLED, most_bins**2) / n) for n in numbers]
    seeds = sorted({seed for seed, _ in models})
    drawn = table.withColumn("u", F.array(*[_uniform(s, ["row_id", *[f"y_{t}" for t in targets]]) for s in seeds]))
    drawn = drawn.filter((F.col("fold") >= 0) & (F.array_min("u") < max(shares)))
    values = drawn.select("fold", "u", F.posexplode(_values(table)).alias("feature", "v"))

    def find(key: tuple, group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        fold, v = group["fold"].to_numpy(), group["v"].to_numpy()
        u = group["u"].chunk(0).flatten().to_numpy().reshape(len(v), len(seeds))
        made = [
            thresholds(v[(fold != own) & (u[:, seeds.index(seed)] < share)], min(most_bins, n))
            for (seed, own), share, n in zip(models, shares, numbers)
        ]
        columns = [[key[0].as_py()] * len(made), list(range(len(made))), [m.tolist() for m in made]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.list_(pa.float64())))], names=["feature", "model", "cuts"])

    found = {(r.feature, r.model): np.array(r.cuts, float) for r in values.groupBy("feature").applyInArrow(find, "feature int, model int, cuts array<double>").collect()}
    none = np.empty(0)
    each = [[found.get((f, m), none) for f in range(width)] for m in range(len(models))]
    cuts = [np.unique(np.concatenate([own[f] for own in each])) for f in range(width)]
    return Bins(cuts, [[np.searchsorted(cuts[f], own[f]) for f in range(width)] for own in each])


def _binned(table: DataFrame, targets: Sequence[str], bins: Bins) -> DataFrame:
    """The rows with a bin for each feature, stored."""
    cuts, kind, n_targets = bins.cuts, bins.kind, len(targets)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), len(cuts))
            codes = np.empty(x.shape, kind)
            for f, own in enumerate(cuts):
                codes[:, f] = np.searchsorted(own, x[:, f])
            parts = [batch.column(0), batch.column(1), _to_bytes(codes), _to_bytes(_matrix(batch.column(3), n_targets))]
            yield pa.record_batch(parts, names=["row_id", "fold", "codes", "y"])

    read = table.select("row_id", "fold", _values(table).alias("x"), F.array(*[F.col(f"y_{t}") for t in targets]).alias("y"))
    return materialise(read.mapInArrow(run, f"row_id {_key(table)}, fold int, codes binary, y binary"), "binned")


def _key(table: DataFrame) -> str:
    return table.schema["row_id"].dataType.simpleString()


def _best_splits(counts: np.ndarray, sums: np.ndarray, at: np.ndarray, least: int, least_gain: float) -> Iterator[tuple]:
    """(place in ``at`` or -1, gain, left count, left sum, count, sum) for each line of the histograms; a split is behind a bin of ``at``."""
    counts, sums = np.broadcast_to(counts.cumsum(-1), sums.shape), sums.cumsum(-1)
    n, s = counts[:, -1:], sums[:, -1:]
    left_n, left_s = counts[:, at], sums[:, at]
    with np.errstate(divide="ignore", invalid="ignore"):
        gap = left_s / left_n - (s - left_s) / (n - left_n)
        gain = left_n * (n - left_n) / (n * n) * gap * gap
        gain = np.where((left_n >= least) & (n - left_n >= least) & (gain >= least_gain), gain, -1.0)
    for line in range(len(sums)):
        place = int(gain[line].argmax()) if len(at) else -1
        if place < 0 or gain[line, place] <= 0:
            yield -1, -1.0, 0.0, 0.0, float(n[line, 0]), float(s[line, 0])
        else:
            yield place, float(gain[line, place]), float(left_n[line, place]), float(left_s[line, place]), float(n[line, 0]), float(s[line, 0])


def _met(partial: DataFrame, splits: Callable[[int, int, np.ndarray], list[tuple]]) -> dict[tuple[int, int], object]:
    """The best split per (unit, slot) of histograms (unit, feature, part, cells); ``splits`` gives a feature's lines from the whole histogram."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        # in the order of the parts, so a sum has the same last digits each time
        order = np.argsort(group["part"].to_numpy())
        cells = group["cells"].to_pylist()
        total = np.sum([np.frombuffer(cells[i]) for i in order], axis=0)
        lines = splits(key[0].as_py(), key[1].as_py(), total)
        types = [pa.int32()] * 4 + [pa.float64()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(zip(*lines), types)], names=[c.split()[0] for c in _SPLIT.split(", ")])

    found = partial.groupBy("unit", "feature").applyInArrow(run, _SPLIT)
    rest = ("cut", "left_n", "left_s", "n", "s")
    best = found.groupBy("unit", "slot").agg(F.max(F.struct("gain", (-F.col("feature")).alias("minus"), *rest)).alias("best"))
    told = best.select("unit", "slot", "best.gain", (-F.col("best.minus")).alias("feature"), *[f"best.{c}" for c in rest])
    return {(r.unit, r.slot): r for r in told.collect()}


def _cells(unit: int, made: Iterable[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    part, made = TaskContext.get().partitionId(), list(made)
    columns = [[unit] * len(made), [f for f, _ in made], [part] * len(made), [cells.tobytes() for _, cells in made]]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], names=["unit", "feature", "part", "cells"])


_PARTIAL = "unit int, feature int, part int, cells binary"


def _roots(rows: Rows, models: Sequence[Grown], folds: Sequence[int], least: int, least_gain: float) -> dict[tuple[int, int], object]:
    """The first splits of all models on the targets themselves: one histogram per feature, fold and target serves all of them."""
    bins, chunks, targets = rows.bins, rows.chunks(), rows.targets
    widths, known = [len(c) + 1 for c in bins.cuts], np.array(folds)
    of_target = {t: [m.number for m in models if m.target == t] for t in range(targets)}
    kinds = sorted({(m.number, m.fold) for m in models})
    place = {(m.target, m.number): i for i, m in enumerate(models)}

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((targets + 1, len(known) * w)) for w in widths]
        for _, fold, codes, y, _, _ in chunks(batches):
            own, codes, y = np.searchsorted(known, fold), np.ascontiguousarray(codes.T), np.ascontiguousarray(y.T)
            for f, w in enumerate(widths):
                index = own * w + codes[f]
                total[f][0] += np.bincount(index, minlength=len(known) * w)
                for t in range(targets):
                    total[f][t + 1] += np.bincount(index, y[t], len(known) * w)
        for f, cells in enumerate(total):
            yield _cells(0, [(f, cells)])

    def splits(_: int, f: int, cells: np.ndarray) -> list[tuple]:
        cells, lines = cells.reshape(targets + 1, len(known), widths[f]), []
        for number, fold in kinds:
            sums, at = cells[:, known != fold].sum(1), bins.own[number][f]
            for t, (cut, *best) in enumerate(_best_splits(sums[:1], sums[1:], at, least, least_gain)):
                if number in of_target[t]:
                    lines.append((place[t, number], 0, f, int(at[cut]) if cut >= 0 else -1, *best))
        return lines

    return _met(rows.table.filter(F.col("fold") >= 0).mapInArrow(fill, _PARTIAL), splits)


def _prediction(model: Grown, rows_before: int, place: int, codes: np.ndarray, before: np.ndarray, end: int | None = None) -> np.ndarray:
    """The predictions of a model by its trees up to ``end``, those of ``rows_before`` rounds being known."""
    total = before[:, place] if rows_before else np.zeros(len(codes))
    for weight, tree in model.weighted(rows_before, end):
        total = total + weight * tree.predict(codes)
    return total


def _passes(models: Sequence[Grown], active: Mapping[int, Sequence[int]], bins: Bins) -> Iterator[list[tuple[int, list[int]]]]:
    """The active nodes as (model, nodes), in groups whose histograms fit a pass."""
    held, size = [], 0
    for i, nodes in active.items():
        one = 16 * sum(len(own) + 1 for own in bins.own[models[i].number])
        step = max(1, HISTOGRAM_BYTES // one)
        for start in range(0, len(nodes), step):
            some = list(nodes[start : start + step])
            if held and size + one * len(some) > HISTOGRAM_BYTES:
                yield held
                held, size = [], 0
            held, size = [*held, (i, some)], size + one * len(some)
    if held:
        yield held


def _level(rows: Rows, models: Sequence[Grown], units: Sequence[tuple[int, list[int]]], trees: Mapping[int, Tree], residual: Callable, least: int, least_gain: float) -> dict[tuple[int, int], object]:
    """The best split of each of the nodes in ``units``, by (model, node): a histogram for each model."""
    bins, chunks, before = rows.bins, rows.chunks(), rows.rounds
    used = {i: models[i] for i, _ in units}
    growing = {i: trees[i] for i, _ in units}
    width = len(bins.cuts)

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_bins = {m.number: [bins.own_bins(m.number, f) for f in range(width)] for m in used.values()}
        total = [[np.zeros((2, len(nodes) * (len(own) + 1))) for own in bins.own[used[i].number]] for i, nodes in units]
        of_model = [(i, list(some)) for i, some in groupby(range(len(units)), lambda unit: units[unit][0])]
        for _, fold, codes, y, now, _ in chunks(batches):
            for i, some in of_model:
                model = used[i]
                own = np.flatnonzero(fold != model.fold)
                label = y[own, model.target]
                if model.trees:
                    label = residual(label, _prediction(model, before, i, codes[own], now[own]))
                node = growing[i].place(codes[own])
                for unit in some:
                    nodes, made = units[unit][1], total[unit]
                    slots = np.full(max(len(growing[i].feature), 1), -1)
                    slots[nodes] = np.arange(len(nodes))
                    inside = np.flatnonzero(slots[node] >= 0)
                    slot, to_add, mine = slots[node[inside]], label[inside], np.ascontiguousarray(codes[own[inside]].T)
                    for f, to in enumerate(own_bins[model.number]):
                        w = to[-1] + 1
                        index = slot * w + to[mine[f]]
                        made[f][0] += np.bincount(index, minlength=len(nodes) * w)
                        made[f][1] += np.bincount(index, to_add, len(nodes) * w)
        for unit, made in enumerate(total):
            yield _cells(unit, enumerate(made))

    def splits(unit: int, f: int, cells: np.ndarray) -> list[tuple]:
        i, nodes = units[unit]
        own = bins.own[used[i].number][f]
        counts, sums = cells.reshape(2, len(nodes), len(own) + 1)
        found = _best_splits(counts, sums, np.arange(len(own)), least, least_gain)
        return [(unit, slot, f, int(own[cut]) if cut >= 0 else -1, *best) for slot, (cut, *best) in enumerate(found)]

    best = _met(rows.table.filter(F.col("fold") >= 0).mapInArrow(fill, _PARTIAL), splits)
    return {(units[unit][0], units[unit][1][slot]): found for (unit, slot), found in best.items()}


def _errors(rows: Rows, models: Sequence[Grown], running: Sequence[int], error: Callable) -> dict[int, float]:
    """The mean error of the running models on their held-out rows; none where there are none."""
    chunks, before = rows.chunks(), rows.rounds
    used = {i: models[i] for i in running}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {i: np.zeros(2) for i in used}
        for _, fold, codes, y, now, _ in chunks(batches):
            held = {f: np.flatnonzero(fold == f) for f in {m.fold for m in used.values()}}
            for i, model in used.items():
                own = held[model.fold]
                if len(own):
                    made = error(y[own, model.target], _prediction(model, before, i, codes[own], now[own]))
                    total[i] += made.sum(), len(own)
        part = TaskContext.get().partitionId()
        columns = [list(total), [part] * len(total), [t[0] for t in total.values()], [t[1] for t in total.values()]]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.float64(), pa.float64()))], names=["model", "part", "s", "n"])

    parts = rows.table.filter(F.col("fold") >= 0).mapInArrow(run, "model int, part int, s double, n double")
    in_order = F.array_sort(F.collect_list(F.struct("part", "s")))
    told = parts.groupBy("model").agg(F.sum("n").alias("n"), F.aggregate(in_order, F.lit(0.0), lambda total, p: total + p["s"]).alias("s"))
    return {r.model: r.s / r.n for r in told.collect() if r.n}


def _best(rows_before: int, models: Sequence[Grown]) -> Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """The predictions of a model at its best round, from (model, codes, now, best) of rows."""

    def of(i: int, codes: np.ndarray, now: np.ndarray, best: np.ndarray) -> np.ndarray:
        if rows_before and models[i].rounds <= rows_before:
            return best[:, i]
        return _prediction(models[i], rows_before, i, codes, now, models[i].rounds)

    return of


def _stored(rows: Rows, models: Sequence[Grown], rounds: int) -> Rows:
    """The rows with the predictions after ``rounds`` rounds, stored."""
    chunks, before, best_of = rows.chunks(), rows.rounds, _best(rows.rounds, models)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, fold, codes, y, now, best in chunks(batches):
            new = np.column_stack([_prediction(m, before, i, codes, now) for i, m in enumerate(models)])
            kept = np.column_stack([best_of(i, codes, now, best) for i in range(len(models))])
            parts = [ids, pa.array(fold, pa.int32()), *[_to_bytes(part) for part in (codes, y, new, kept)]]
            yield pa.record_batch(parts, names=["row_id", "fold", "codes", "y", "now", "best"])

    made = rows.table.mapInArrow(run, f"row_id {_key(rows.table)}, fold int, codes binary, y binary, now binary, best binary")
    return Rows(materialise(made, "boosted"), rows.bins, rows.targets, rows.models, rounds)


def _scored(rows: Rows, models: Sequence[Grown]) -> DataFrame:
    """(row_id, fold, truth, own, mean), stored: per target the truth and the mean prediction; ``own`` has the predictions by target
    and seed of a train row's held-out models, of which ``mean`` is the average over seeds; in test rows it is that of all models."""
    chunks, best_of, targets = rows.chunks(), _best(rows.rounds, models), rows.targets
    by_fold = {f: [i for i, m in enumerate(models) if m.fold == f] for f in {m.fold for m in models}}

    def lists(values: np.ndarray) -> pa.Array:
        offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, fold, codes, y, now, best in chunks(batches):
            for f in np.unique(fold).tolist():
                at = np.flatnonzero(fold == f)
                used = by_fold.get(f, []) if f >= 0 else range(len(models))
                if not len(used):
                    continue
                each = [best_of(i, codes[at], now[at], best[at]) for i in used]
                per = len(each) // targets
                mean = np.column_stack([sum(each[t * per + 1 : (t + 1) * per], each[t * per]) / float(per) for t in range(targets)])
                own = np.column_stack(each) if f >= 0 else np.empty((len(at), 0))
                parts = [ids.take(pa.array(at)), pa.array(fold[at], pa.int32()), lists(y[at]), lists(own), lists(mean)]
                yield pa.record_batch(parts, names=["row_id", "fold", "truth", "own", "mean"])

    made = rows.table.mapInArrow(run, f"row_id {_key(rows.table)}, fold int, truth array<double>, own array<double>, mean array<double>")
    return materialise(made, "scored")


def _grow_round(rows: Rows, models: Sequence[Grown], running: Sequence[int], folds: Sequence[int], params: Mapping[str, object]) -> None:
    """Give each running model its next tree, level by level."""
    least, least_gain = int(params["minInstancesPerNode"]), float(params["minInfoGain"])
    shared = 8 * (rows.targets + 1) * len(folds) * sum(len(c) + 1 for c in rows.bins.cuts)
    first = not models[running[0]].trees and shared <= HISTOGRAM_BYTES
    residual = ON_ARRAYS[params["lossType"]][0]
    trees, active = {i: Tree() for i in running}, {i: [0] for i in running}
    for depth in range(max(1, int(params["maxDepth"]))):
        if depth == 0 and first:
            found = {(running[place], 0): best for (place, _), best in _roots(rows, [models[i] for i in running], folds, least, least_gain).items()}
        else:
            found = {}
            for units in _passes(models, active, rows.bins):
                found |= _level(rows, models, units, trees, residual, least, least_gain)
        grew: dict[int, list[int]] = {}
        for (i, node), best in sorted(found.items(), key=lambda item: item[0]):
            if depth == 0:
                trees[i].add(best.n, best.s)
            if best.cut >= 0 and depth < int(params["maxDepth"]):
                grew.setdefault(i, []).extend(trees[i].split(node, best))
        active = grew
        if not active:
            break
    for i, tree in trees.items():
        models[i].trees.append(tree)


def boost_together(
    table: DataFrame,
    targets: Sequence[str],
    models: Sequence[tuple[int, int]],
    params: Mapping[str, object],
    patience: int | None,
) -> Iterator[tuple[list[str], DataFrame, list[Grown]]]:
    """Boost a model for each target and (seed, fold) of ``models``, by seed and all folds, on ``table`` (from ``assemble``).

    Gives, for groups of targets (one, up to ``MOST_MODELS`` models), their names, the scored rows (``_scored``) and the
    models by target. Stops as ``boosting.boost`` does: a model leaves when its held-out rows have passed ``patience`` rounds without a new
    low. Without a patience all rounds count, and no errors are found.
    """
    params = {**PARAMS, **params}
    if params["lossType"] not in LOSSES:
        raise ValueError(f"unknown loss {params['lossType']!r}; known: {sorted(LOSSES)}")
    width = table.schema["features"].metadata["ml_attr"]["num_attrs"]
    lacking = F.lit(False)
    for t in targets:
        lacking = lacking | F.col(f"y_{t}").isNull() | F.isnan(f"y_{t}")
    told = table.filter(F.col("fold") >= 0).groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count_if(lacking).alias("lacking")).collect()
    if any(r.lacking for r in told):
        raise ValueError("train rows without a target")
    sizes = {r.fold: r.n for r in told}
    for _, fold in models:
        if not any(f != fold for f in sizes):
            raise ValueError(f"no train rows outside fold {fold}")
    bins = _bins(table, targets, models, sizes, width, int(params["maxBins"]))
    error = ON_ARRAYS[params["lossType"]][1]
    each = max(1, MOST_MODELS // len(models))
    for start in range(0, len(targets), each):
        group = list(targets[start : start + each])
        grown = [
            Grown(t, seed, fold, number, float(params["stepSize"]), width) for t in range(len(group)) for number, (seed, fold) in enumerate(models)
        ]
        rows = Rows(_binned(table, group, bins), bins, len(group), len(grown))
        running = list(range(len(grown)))
        for number in range(int(params["maxIter"])):
            _grow_round(rows, grown, running, sorted(sizes), params)
            told = _errors(rows, grown, running, error) if patience is not None else {}
            for i in list(running):
                model = grown[i]
                if patience is None:
                    model.rounds = number + 1
                    continue
                model.errors.append(told.get(i, float("inf")))
                model.rounds, stopped = best_round(model.errors, patience)
                if stopped:
                    running.remove(i)
            if not running:
                break
            if (number + 1) % STORED_EVERY == 0 and number + 1 < int(params["maxIter"]):
                rows = _stored(rows, grown, number + 1)
        yield group, _scored(rows, grown), grown
