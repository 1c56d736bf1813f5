"""From raw documents to packed training sequences.

Each stage takes all rows that the one before kept. Rows that a stage drops or
changes stay so for the next ones; all but the last give the columns of
``documents``. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwright.llm import toxicity
from foldwright.llm.batches import free_name
from foldwright.llm.decontaminate import decontaminated
from foldwright.llm.packing import pack
from foldwright.llm.queries import BYTE_BPE, table
from foldwright.llm.simhash import keep_one
from foldwright.llm.substring import dedup_substrings
from foldwright.session import set_up
from foldwright.workspace import materialise


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is fitted on the labels that are not held out."""
    set_up(spark)
    model = toxicity.fit(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    return toxicity.drop_toxic(docs, model)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints of four-word shingles within four bits, the smallest doc_id stays."""
    set_up(spark)
    return keep_one(docs, words=4, radius=4)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in a 13-word window that an earlier document has go from the text, and ``n_chars`` follows if there is one.

    Texts that lose nothing stay as they are, and all rows stay, with an empty
    text where every word went. Other columns stay as they are, whatever their names.
    """
    set_up(spark)
    counts = free_name("n_words", docs.columns), free_name("n_removed", docs.columns)
    found = dedup_substrings(docs, words=13, rejoin=False, counts=counts)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.col(counts[1]) > 0, length).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def without_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    set_up(spark)
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in sequences of at most 2048 tokens."""
    set_up(spark)
    return pack(docs, public_tokenizers.path(BYTE_BPE), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("simhash_near_dedup", one_of_near_duplicates),
    ("substring_dedup", without_repeated_passages),
    ("benchmark_decontamination", without_benchmark_items),
    ("best_fit_packing", packed),
]

#: Fingerprints, components, the classifier and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    set_up(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
