"""Session settings the library is tuned for."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from foldwright.workspace import CHECKPOINT_SETTING, shared_dir_setting

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: Rows and bytes that go to a Python worker at once. Long texts make Spark's default batches tens of
#: megabytes, held several times over by the executor and the worker.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def local_session(cpus: int | str = "*", app: str = "foldwright", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    set_up(spark)
    return spark


def set_up(spark: SparkSession) -> None:
    """Make a session that the caller did not set up ready for the queries.

    Executors get this package if they cannot import it by themselves, and a
    local session without ``spark.checkpoint.dir`` gets a folder of this machine.
    Elsewhere the setting is required, and the library says so when it is missing.
    Batches for Python workers are kept small where the caller has not set them.
    """
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    context = spark.sparkContext
    if context.master.startswith("local[") or context.master == "local":
        if not shared_dir_setting(spark):
            spark.conf.set(CHECKPOINT_SETTING, f"file://{tempfile.mkdtemp(prefix='foldwright-')}")
    if not getattr(context, "_foldwright_shipped", False):
        context._foldwright_shipped = True
        context.addPyFile(_archive())


def _archive() -> str:
    """This package as a zip file, which Spark's driver hands to the executors."""
    package = Path(__file__).resolve().parent
    path = f"{tempfile.mkdtemp(prefix='foldwright-')}/foldwright.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    return path
