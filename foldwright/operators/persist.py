"""Fitted tables with their description, stored for later sessions."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def save_table(table: DataFrame, about: dict, path: str, partition_by: Sequence[str] = ()) -> None:
    table.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/table")
    save_about(table, about, path)


def save_about(table: DataFrame, about: dict, path: str) -> None:
    text = table.sparkSession.range(1).select(F.lit(json.dumps({**about, "schema": table.schema.json()})))
    text.coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_table(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    about = json.loads(spark.read.text(f"{path}/about").first()[0])
    schema = StructType.fromJson(json.loads(about.pop("schema")))
    stored = spark.read.schema(schema).parquet(f"{path}/table")
    return stored.select(*[F.col(f"`{c}`") for c in schema.names]), about
