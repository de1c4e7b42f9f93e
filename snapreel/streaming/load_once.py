"""Load every new snapshot file exactly once into the raw trending table.

The bulk load skips files it already loaded. The streaming file source does
the same through its checkpoint (a log of seen files), and the Parquet file
sink is exactly-once through its own metadata log: files of a micro-batch
that failed midway are never listed for readers, and a re-run batch is
committed once. ``trigger(availableNow=True)`` processes whatever is new
and stops, so a daily job can call it and a rerun adds nothing.

A document delivered again under another file name is a new file to the source.
With ``redelivery_window`` the stream keeps the documents' digests as state and
drops what it has seen. The watermark runs on the files' arrival (modification)
time, so state goes ``redelivery_window`` after a document came and old
snapshots that arrive now are not late; a row that is late all the same makes
the pass fail instead of being lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapreel.sources.raw_loaders import load_trending_raw
from snapreel.sources.schemas import SLICE_KEY
from snapreel.sources.snapshots import PARTITION_COLUMN, source_path

_TEXT_SCHEMA = T.StructType([T.StructField("value", T.StringType()),
                             T.StructField("snapshot_date", T.DateType())])


class LateDocumentsError(RuntimeError):
    """Documents were left out because their files are older than the stream's state."""


def trending_stream(spark: SparkSession, store_root: str, max_files_per_trigger: int | None = None,
                    redelivery_window: str | None = None) -> DataFrame:
    """Streaming DataFrame of raw trending rows from the snapshot store, each
    document once within ``redelivery_window`` (e.g. ``"30 days"``)."""
    path = source_path(store_root, "trending")
    reader = spark.readStream.schema(_TEXT_SCHEMA).option("basePath", path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.text(path)
    lines = lines.where(F.trim("value") != "")
    if redelivery_window:
        seen = ["digest", "snapshot_date"]
        lines = (lines.select("value", "snapshot_date", F.col("_metadata.file_modification_time").alias("arrived"))
                 .withColumn("digest", F.sha2(F.col("value").cast("binary"), 256))
                 .withWatermark("arrived", redelivery_window).dropDuplicatesWithinWatermark(seen))
    docs = (lines
            .select(F.parse_json(F.make_valid_utf8("value")).alias("doc"),
                    F.col(PARTITION_COLUMN["trending"]).alias("snapshot_date")))
    return load_trending_raw(docs, snapshot_date=F.col("snapshot_date"))


def load_new_snapshots(spark: SparkSession, store_root: str, raw_table_path: str,
                       checkpoint_path: str, max_files_per_trigger: int | None = None,
                       redelivery_window: str | None = None) -> int:
    """Run one available-now pass; returns the number of documents read in it.

    ``max_files_per_trigger`` splits a large backlog (e.g. the first pass over
    years of snapshots) into several bounded micro-batches; available-now
    still processes all of it before stopping.
    """
    q = (trending_stream(spark, store_root, max_files_per_trigger, redelivery_window).writeStream
         .format("parquet")
         .partitionBy(*SLICE_KEY)
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True)
         .start(raw_table_path))
    q.awaitTermination()
    late = sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for s in p.get("stateOperators", []))
    if late:
        raise LateDocumentsError(f"{late} documents arrived with a file time before the redelivery window")
    return int(sum(p.get("numInputRows", 0) for p in q.recentProgress))


def read_loaded(spark: SparkSession, raw_table_path: str) -> DataFrame:
    """All raw rows the stream has committed so far (read through the sink's log)."""
    return spark.read.parquet(raw_table_path)
