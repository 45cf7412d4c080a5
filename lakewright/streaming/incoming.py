"""Files arriving in a folder, ingested as they come: every micro-batch is a batch of the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakewright.operators.ingestion import ingest_batch, open_batch, plain_path
from lakewright.sources.lake import Lake


def ingest_arrivals(
    lake: Lake, folder: str, checkpoint: str, source_id: str, source_type: str,
    dictionary: DataFrame, type_decisions: DataFrame | None = None, prefix: str = "ARRIVAL",
    max_files: int = 1000,
) -> StreamingQuery:
    """Ingest the files not seen before and stop. Only paths flow through the stream. The ingest
    is named by the stream's own id, which its checkpoint keeps, and the micro-batch number: a
    batch repeated after a failure replaces its own rows, one that succeeded is left alone, and
    another stream of the same source never meets its names."""
    arrivals = (
        lake.spark.readStream.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", max_files)
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .load(folder)
        .select("path")
    )

    def load(batch: DataFrame, number: int) -> None:
        stream = lake.spark.read.json(f"{checkpoint}/metadata").first()["id"]
        ingest_id = f"{prefix}_{source_id}_{stream}_{number:08d}"
        paths = sorted(plain_path(r["path"]) for r in batch.collect())  # at most max_files
        if not paths:
            return
        known = None
        if lake.exists("governance", "batch_log"):
            known = lake.read("governance", "batch_log").where(
                F.col("ingest_id") == ingest_id
            ).first()
        if known is None:
            open_batch(lake, ingest_id, source_id, paths)
        else:
            log = lake.read("governance", "ingest_file_log")
            logged = log.where(F.col("ingest_id") == ingest_id).select("file_path").collect()
            if sorted(r["file_path"] for r in logged) != paths:
                raise ValueError(f"ingest {ingest_id} is logged with other files")
            if known["status"] == "success":
                return
        ingest_batch(lake, ingest_id, source_id, source_type, dictionary, type_decisions)

    return (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
