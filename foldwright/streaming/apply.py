"""Fitted encoders on a stream.

Every transform is a projection and left joins to fixed tables, so
it applies to a streaming DataFrame as it does to a batch one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..workspace import fresh_path


def apply_available(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str | None = None
) -> DataFrame:
    """Run ``transform`` over what the stream holds now, into parquet, and return the stored rows.

    The offsets live next to the output in the shared folder, so a restart goes on where it ended.
    """
    spark = stream.sparkSession
    path = path or fresh_path(spark, "stream")
    out = transform(stream)
    query = (
        out.writeStream.format("parquet")
        .option("path", f"{path}/rows")
        .option("checkpointLocation", f"{path}/offsets")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/rows")
