"""Encoders fitted on a stream, batch by batch.

Each batch is aggregated to a state (sums and counts), merged with the state
of all earlier batches, and kept as a version named by the batch's number. The
description of a version is written after its table, and only then does the version count. A
batch that is delivered again finds its number taken and changes nothing;
one that failed halfway writes its version anew.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class State(Protocol):
    """What can be added up and stored: ``TargetState``, ``FittedCount`` and ``FittedOrdinal`` are such."""

    def merge(self, *others): ...

    def save(self, path: str) -> None: ...

    @classmethod
    def load(cls, spark: SparkSession, path: str): ...


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the last batch whose version is complete."""
    try:
        told = spark.read.text(f"{path}/version=*/about").select(F.regexp_extract(F.input_file_name(), r"/version=(\d+)/", 1).cast("long").alias("v"))
        return told.agg(F.max("v")).first()[0]
    except AnalysisException as missing:  # no version yet
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_state(spark: SparkSession, path: str, kind: type[State]) -> State | None:
    """The state of all batches so far, or None before the first."""
    version = latest_version(spark, path)
    return None if version is None else kind.load(spark, f"{path}/version={version}")


def add_batch(rows: DataFrame, number: int, fit: Callable[[DataFrame], State], kind: type[State], path: str) -> bool:
    """Add the rows of batch ``number`` to the state at ``path``, unless it has them; whether it did."""
    version = latest_version(rows.sparkSession, path)
    if version is not None and version >= number:
        return False
    state = fit(rows)
    if version is not None:
        state = kind.load(rows.sparkSession, f"{path}/version={version}").merge(state)
    state.save(f"{path}/version={number}")
    return True


def fit_available(stream: DataFrame, fit: Callable[[DataFrame], State], kind: type[State], path: str) -> State | None:
    """Add what the stream holds now to the state at ``path``, and give the state.

    The offsets lie beside the versions, so a restart goes on after the last
    batch. A batch costs one aggregate of its own rows and a merge of aggregated ones.
    """

    def add(rows: DataFrame, number: int) -> None:
        add_batch(rows, number, fit, kind, path)

    query = stream.writeStream.foreachBatch(add).option("checkpointLocation", f"{path}/offsets").trigger(availableNow=True).start()
    query.awaitTermination()
    return load_state(stream.sparkSession, path, kind)
