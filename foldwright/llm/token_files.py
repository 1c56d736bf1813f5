"""Token ids of a corpus as files of grammar-compressed shards, and back.

A shard is a stretch of documents in ascending order of the key with its own
Re-Pair grammar (``repair``). The files are parquet, one row per shard, so any
store that Spark reaches will do: the shard's bytes, the keys of its documents,
and its place (the task, which follows the key ranges, and the number in it).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldwright.workspace import fresh_path

from .batches import arrow_schema, begin_task, pieces_of, task_number, text_rows
from .pieces import encoder
from .repair import Shard, pack_shard

#: Ids after which a shard is closed; a longer document has a shard of its own. The grammar of a smaller shard is found with
#: less memory traffic (two million ids as two shards take 0.7 of the time) and shares its rules among fewer ids (7 % more bytes).
SHARD_IDS = 1_000_000

SHARDS = "part long, shard long, n_ids long, keys array<long>, data binary"
DOCUMENTS = "part long, shard long, doc_id long, first long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of every document, each ended by ``end_id``, to shards in ascending order of ``key``.

    Nulls: a null text is empty (its end id alone), null keys come first. Rows
    with one key are ordered by their text, so ties and repeated rows have a
    place too; the ranges also cut by a hash of the text, so a key with many
    texts is spread. Other columns are not read. One shuffle, of the texts.
    """
    schema = arrow_schema(docs.sparkSession, SHARDS)

    def run(batches):
        begin_task(__name__)
        encode, part, shard = encoder(tokenizer), task_number(), 0
        end = np.array([end_id], "<u4").tobytes()
        keys, ids, n = [], [], 0

        def close():
            data = b"".join(ids)
            lengths = np.array([len(x) // 4 for x in ids], np.int64)
            columns = [[part], [shard], [n], [keys], [pack_shard(lengths, np.frombuffer(data, "<u4"), end_id)]]
            return pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

        for batch in pieces_of(batches, 256):
            for doc, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = encode(words) + end
                if keys and n + len(own) // 4 > SHARD_IDS:
                    yield close()
                    keys, ids, n, shard = [], [], 0, shard + 1
                keys.append(doc)
                ids.append(own)
                n += len(own) // 4
        if keys:
            yield close()

    rows = text_rows(docs, key, text).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    ordered.select("doc_id", "text").mapInArrow(run, SHARDS).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the ids before it in the whole corpus. The totals per shard
    are added up in two steps, over the shards of a task and over the tasks.
    """
    shards = spark.read.parquet(path)
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before_part"))
    places = (
        shards.select("part", "shard", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("before"))
        .join(parts, "part")
        .select("part", "shard", (F.col("before") + F.col("before_part")).alias("shard_start"))
    )
    schema = arrow_schema(spark, DOCUMENTS)

    def decode(batches):
        begin_task(__name__)
        for batch in pieces_of(batches, 1):
            part, number, _, keys, data = (batch.column(i)[0].as_py() for i in range(5))
            shard = Shard(data)
            ids = shard.ids(0, shard.n_ids).astype("<u4").tobytes()
            first = np.cumsum(shard.doc_lengths) - shard.doc_lengths
            crcs = [zlib.crc32(ids[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), shard.doc_lengths.tolist())]
            columns = [[part] * len(keys), [number] * len(keys), keys, first, shard.doc_lengths, crcs]
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

    decoded = shards.select("part", "shard", "n_ids", "keys", "data").mapInArrow(decode, DOCUMENTS)
    return decoded.join(places, ["part", "shard"]).select(
        "doc_id", (F.col("first") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files (to the shared folder by default) and read them back."""
    path = path or fresh_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, end_id, key, text)
    return read_token_files(docs.sparkSession, path)
