"""Quoted CSV files read by many tasks each.

A line break ends a record only outside quotes, that is, after an even number
of quote marks (a mark inside a quoted field is written twice, which counts even). The
lines of a file are read by blocks; the parity of the marks before a line is that
within its block, plus that of the blocks before, one row each. Lines between two record
starts are joined, and each record is parsed by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.lookup import TABLE_BYTES, attach, store
from ..operators.running import running_total
from ..workspace import materialise


def read_records(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], quote: str = '"', number: str | None = None, **options: str) -> DataFrame:
    """The records of CSV files with a header, every field as text, in as many tasks as the files have blocks.

    ``columns`` are the names of the fields; the first record of each file is left out. ``number`` names
    a column for the 0-based place of a record in the files, in path order. Lines
    end with a line feed, or a carriage return before it; line breaks in a field stay as they are written. Empty lines
    outside quotes are no records. ``options`` are those of Spark's CSV reader.
    """
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )
    stored = materialise(lines, "lines")
    marks = (F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))) % 2
    before = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # outside: whether the line begins outside quotes if its block does
    placed = stored.select("*", (F.coalesce(F.sum(marks).over(before), F.lit(0)) % 2 == 0).alias("outside"), marks.alias("marks"))
    blank = F.trim(F.regexp_replace("line", "\r$", "")) == ""
    placed = materialise(placed.withColumn("blank", blank), "marked-lines")
    begins = {kind: F.count_if((F.col("outside") == kind) & ~F.col("blank")) for kind in (True, False)}
    counts = placed.groupBy("file", "block").agg(F.sum("marks").alias("marks"), begins[True].alias("if_out"), begins[False].alias("if_in"))
    blocks, size = store(counts, "blocks")
    turned = running_total(blocks, ["file"], ["block"], "marks", "marks_end", size.rows)
    inside = (F.col("marks_end") - F.col("marks")) % 2 == 1
    started = materialise(turned.select("file", "block", inside.alias("inside"), F.when(inside, F.col("if_in")).otherwise(F.col("if_out")).alias("records")), "turned")
    numbered = running_total(started, [], ["file", "block"], "records", "records_end", size.rows)
    offsets = numbered.select("file", "block", "inside", (F.col("records_end") - F.col("records")).alias("records_before"))
    known = attach(
        placed, offsets, [(F.col("file"), "file"), (F.col("block"), "block")], {"inside": "inside", "records_before": "records_before"},
        null_safe=False, small=size.bytes <= TABLE_BYTES,
    )
    begins = (F.col("outside") != F.col("inside")) & ~F.col("blank")
    so_far = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a blank line outside quotes belongs to no record
    whole = known.select("file", "block", "at", "line", "records_before", begins.alias("begins"), ((F.col("outside") != F.col("inside")) & F.col("blank")).alias("empty"))
    whole = whole.withColumn("record", F.col("records_before") + F.sum(F.col("begins").cast("long")).over(so_far)).filter(~F.col("empty"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "line"))), lambda part: part["line"])
    text = F.regexp_replace(F.array_join(parts, "\n"), "\r$", "")
    records = whole.groupBy("file", "record").agg(text.alias("text"))
    firsts = started.groupBy("file").agg(F.sum("records").alias("n"))
    files, n_files = store(firsts, "files")
    ends = running_total(files, [], ["file"], "n", "end", n_files.rows)
    nth = running_total(ends, [], ["file"], None, "nth", n_files.rows).select("file", "nth", (F.col("end") - F.col("n")).alias("earlier"))
    records = attach(records, nth, [(F.col("file"), "file")], {"nth": "nth", "earlier": "earlier"}, null_safe=False, small=n_files.bytes <= TABLE_BYTES)
    rows = records.filter(F.col("record") - F.col("earlier") > 1)
    settings = {"quote": quote, "escape": quote, "multiLine": "true", **{k: str(v) for k, v in options.items()}}
    place = [(F.col("record") - F.col("nth") - 1).alias(number)] if number else []
    return rows.select(*place, F.from_csv("text", _ddl(columns), settings).alias("r")).select(
        *([number] if number else []), "r.*"
    )


def _ddl(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns)
