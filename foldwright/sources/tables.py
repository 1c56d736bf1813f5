"""Reading the input tables and giving every row a key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookup import TABLE_BYTES, attach, store
from ..operators.running import running_total
from ..workspace import materialise
from .missing import infer_types, normalise_missing
from .records import read_records


@dataclass(frozen=True)
class Dataset:
    train: DataFrame
    test: DataFrame
    submission: DataFrame | None = None


def read_texts(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True, **options: str) -> DataFrame:
    """CSV with a header, every field as text; a quote inside a quoted field is written twice.

    With ``multi_line`` a quoted field may hold line breaks, and one task reads
    a whole file: keep large inputs as many files, or say False where no field
    has a line break.
    """
    paths = [path] if isinstance(path, str) else list(path)
    settings = {"header": True, "inferSchema": False, "multiLine": multi_line, "quote": '"', "escape": '"', **options}
    return spark.read.options(**settings).csv(paths)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    row_id: str | None = "row_id",
    multi_line: bool = True,
    split_files: bool = False,
    **options: str,
) -> DataFrame:
    """CSV with a header. Types from ``schema`` or from the data, missing tokens as null, rows numbered.

    Every field is read as text first, so a token such as ``NA`` in a number
    column is missing and not an error. ``row_id`` is the 0-based position in the
    files, in path order; pass a column the file already has to keep that, or None.
    ``multi_line`` and further reader options as for :func:`read_texts`. With
    ``split_files`` a large file with line breaks in its fields is read by many tasks (``records``).
    """
    raw = read_texts(spark, path, multi_line, **options)
    if split_files:
        numbered = row_id if row_id not in raw.columns else None
        raw = read_records(spark, path, raw.columns, number=numbered, **options)
        texts = raw.drop(numbered) if numbered else raw
        schema = infer_types(texts) if schema is None and texts.columns else schema
        return normalise_missing(raw, schema)
    if schema is None and raw.columns:
        schema = infer_types(raw)
    if row_id is None or row_id in raw.columns:
        return normalise_missing(raw, schema)
    return number_rows(raw, row_id, schema)


def number_rows(raw: DataFrame, row_id: str, schema: T.StructType | None = None) -> DataFrame:
    """Number file rows 0.. in (file, block, row) order, in parallel.

    The rows are stored once with their place inside the block; the offsets
    of the blocks, one row each, are added by a join.
    """
    places = raw.select(
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"),
        "*",
    )
    stored = materialise(places, "ingest")
    counts = stored.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"))
    blocks, size = store(counts, "blocks")
    ended = running_total(blocks, [], ["__file", "__block"], "__rows", "__end", size.rows)
    offsets = ended.withColumn("__offset", F.col("__end") - F.col("__rows"))
    numbered = attach(
        stored,
        offsets,
        [(F.col("__file"), "__file"), (F.col("__block"), "__block")],
        {"__from": "__first", "__offset": "__offset"},
        null_safe=False,
        small=size.bytes <= TABLE_BYTES,
    ).withColumn(row_id, F.col("__at") - F.col("__from") + F.col("__offset"))
    return normalise_missing(numbered.select(row_id, *[F.col(f"`{c}`") for c in raw.columns]), schema)


def load_dataset(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | None = None,
    row_id: str | None = "row_id",
    multi_line: bool = True,
    **options: str,
) -> Dataset:
    """``train.csv``, ``test.csv`` and ``sample_submission.csv`` of a folder.

    Without ``schema`` the types are those that fit both train and test, so the
    two unite without loss.
    """
    if schema is None:
        sides = [read_texts(spark, f"{folder}/{name}.csv", multi_line, **options) for name in ("train", "test")]
        schema = infer_types(sides[0].unionByName(sides[1], allowMissingColumns=True))
    train = read_csv(spark, f"{folder}/train.csv", schema, row_id, multi_line, **options)
    test = read_csv(spark, f"{folder}/test.csv", schema, row_id, multi_line, **options)
    submission = read_csv(spark, f"{folder}/sample_submission.csv", None, None, multi_line, **options)
    return Dataset(train, test, submission)
