"""Small helpers of the operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pieces import Memory

#: Rows that a task turns into Python objects at once.
ROWS_AT_ONCE = 2048

_ARROW = {
    T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_(),
    T.StringType(): pa.string(), T.BinaryType(): pa.binary(), T.ArrayType(T.LongType()): pa.list_(pa.int64()),
    T.ArrayType(T.IntegerType()): pa.list_(pa.int32()),
}


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    """The Arrow form of a schema given as text."""
    return pa.schema([(f.name, _ARROW[f.dataType]) for f in T.StructType.fromDDL(ddl)])


def pieces_of(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The batches in small slices. Memory that Arrow no longer uses is given back after each whole one."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
        pa.default_memory_pool().release_unused()


def begin_task(operator: str) -> None:
    """A worker serves one operator after the other: give back what the one before has kept."""
    Memory.use_for(operator)
    pa.default_memory_pool().release_unused()


def map_rows(df: DataFrame, function: Callable[[pa.RecordBatch], list], ddl: str, rows: int = ROWS_AT_ONCE) -> DataFrame:
    """``function`` gives the columns of ``ddl`` for each small batch of ``df``."""
    schema = arrow_schema(df.sparkSession, ddl)

    def run(batches):
        begin_task(function.__module__)
        for batch in pieces_of(batches, rows):
            columns = function(batch)
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

    return df.mapInArrow(run, ddl)


def task_number() -> int:
    return TaskContext.get().partitionId()


def text_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and ``text`` alone, under fixed names; a null text is empty."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with as many marks behind it as no column has, in whatever case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name
