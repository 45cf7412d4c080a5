"""Session helpers for local runs; on a cluster the deployment configures the session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "lakewright", **conf: str) -> SparkSession:
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


#: Partitions of a shuffle of many distinct values, at least, and their bytes after merging. With more
#: than 200 Spark buffers and sorts the rows it writes, which takes more memory in each task.
FINE_PARTITIONS = 200
FINE_BYTES = "8m"


@contextmanager
def finer_shuffles(spark: SparkSession, merged_bytes: str = FINE_BYTES) -> Iterator[None]:
    """Writes inside it shuffle into at least ``FINE_PARTITIONS`` partitions, which adaptive
    execution merges only up to ``merged_bytes``; the session's settings are put back afterwards."""
    count, size = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {key: spark.conf.get(key) for key in (count, size)}
    spark.conf.set(count, str(max(int(before[count]), FINE_PARTITIONS)))
    spark.conf.set(size, merged_bytes)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


#: Rows of an Arrow batch at most, where each row is a whole text.
TEXT_ROWS = 2_000


@contextmanager
def smaller_batches(spark: SparkSession) -> Iterator[None]:
    """Writes inside it pass at most ``TEXT_ROWS`` rows at a time to Python; the session's setting is put back
    afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), TEXT_ROWS) if int(before) > 0 else TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write inside it go when the write ends, not when the driver happens to collect its
    garbage; the session's setting is put back afterwards."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``. Only a local session
    without that setting gets a temporary folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-lakewright-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that several consumers
    share one computation, prune its columns and survive the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lakewright-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
