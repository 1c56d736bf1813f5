"""Fits that several experiments share, kept in a folder.

A fit is found by what decides it: the kind and parameters of the encoder and
the values of the columns it reads, row by row. Whoever changes any of these gets another
fit; whoever changes other columns, or none, gets the stored one.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fingerprints(rows: DataFrame, key: str, cols: Iterable[str]) -> dict[str, str]:
    """Per column, what its (``key``, value) pairs add up to, whatever their order: one aggregate for all columns.

    Two sums of 64-bit hashes and the number of rows, so repeated rows count; the type belongs to it.
    """
    names = sorted(set(cols))
    each = [(i, way) for i in range(len(names)) for way in (0, 1)]
    hashes = rows.select(
        F.spark_partition_id().alias("part"),
        *[F.xxhash64(F.lit(way), F.col(f"`{key}`"), F.col(f"`{names[i]}`")).alias(f"s_{i}_{way}") for i, way in each],
    )
    # the sums of a partition's upper and lower halves fit a long, which is much faster to add to than a decimal
    halves = {"high": lambda h: F.shiftright(h, 32), "low": lambda h: F.col(h).bitwiseAND(F.lit(0xFFFFFFFF))}
    sums = [F.sum(half(f"s_{i}_{way}")).alias(f"{name}_{i}_{way}") for i, way in each for name, half in halves.items()]
    parts = hashes.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), *sums)
    whole = [F.sum(F.col(f"{name}_{i}_{way}").cast("decimal(20,0)")).alias(f"{name}_{i}_{way}") for i, way in each for name in halves]
    told = parts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *whole).first()

    def total(i: int, way: int) -> int | None:
        return (int(told[f"high_{i}_{way}"]) << 32) + int(told[f"low_{i}_{way}"]) if told["rows"] else None

    return {c: f"{rows.schema[c].dataType.simpleString()}:{told['rows']}:{total(i, 0)}:{total(i, 1)}" for i, c in enumerate(names)}


@dataclass(frozen=True)
class FitStore:
    """A folder of fitted encoders that every executor can reach.

    A fit counts once its description is written, which comes last, so one that broke off is made
    anew. One job at a time may write to a folder; any number may read.
    """

    folder: str

    def path(self, encoder, digests: Mapping[str, str]) -> str:
        told = [type(encoder).__name__, encoder.about(), {c: digests[c] for c in encoder.reads()}]
        return f"{self.folder.rstrip('/')}/{sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()}"

    def fit(self, encoder, train: DataFrame, digests: Mapping[str, str]):
        """The stored fit of ``encoder`` on rows with these :func:`fingerprints`, or a new one, stored."""
        path = self.path(encoder, digests)
        try:
            return encoder.fitted.load(train.sparkSession, path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        encoder.fit(train).save(path)
        return encoder.fitted.load(train.sparkSession, path)
