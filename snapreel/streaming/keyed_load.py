"""X1 + S13: stream new details and credits documents into their keyed raw tables.

The file source hands each stored file over once; every micro-batch is upserted
by key (``foreachBatch``), raw table and key index. The number of the last batch
is part of the raw table's published version, in the same step as its rows: a
batch that Spark repeats, because the run died after the rows were published and
before the batch was logged, finds its own number there and adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapreel.operators import keyindex as KI
from snapreel.operators.replace import document_key
from snapreel.session import stage
from snapreel.sources import versions as VT
from snapreel.sources.raw_loaders import RAW_LOADERS
from snapreel.sources.snapshots import PARTITION_COLUMN, source_path

BATCH = "stream_batch"        # layout entry: the last micro-batch whose rows the version holds


def document_stream(spark: SparkSession, store_root: str, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of raw rows from the stored documents of ``details`` or ``credits``."""
    part = PARTITION_COLUMN[source]
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField(part, T.DateType())])
    reader = spark.readStream.schema(schema).option("basePath", source_path(store_root, source))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.text(source_path(store_root, source))
    docs = lines.where(F.trim("value") != "").select(F.parse_json(F.make_valid_utf8("value")).alias("doc"))
    return RAW_LOADERS[source](docs)


def newest_documents(rows: DataFrame) -> DataFrame:
    """One row per document key: the one loaded last (a batch may hold a document twice)."""
    newest = Window.partitionBy(*document_key(rows)).orderBy(F.desc("load_ts"), F.xxhash64(F.to_json("payload")))
    return rows.withColumn("_age", F.row_number().over(newest)).where("_age = 1").drop("_age")


def load_new_documents(spark: SparkSession, store_root: str, raw_root: str, source: str, checkpoint_path: str,
                       max_files_per_trigger: int | None = None, after_batch: Callable[[int], None] | None = None) -> int:
    """Run one available-now pass; returns the number of documents read in it.

    ``after_batch`` is called with a batch's number once its rows are published.
    """
    def upsert(batch: DataFrame, number: int) -> None:
        version = VT.current(batch.sparkSession, KI.raw_path(raw_root, source))
        if version is None or version.layout.get(BATCH, -1) < number:
            rows = stage(newest_documents(batch), "stream-batch")        # read once: raw table and index are written from it
            KI.load(batch.sparkSession, raw_root, source, rows, marks={BATCH: number})
        if after_batch:
            after_batch(number)

    stream = document_stream(spark, store_root, source, max_files_per_trigger)
    query = (stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return int(sum(p.get("numInputRows", 0) for p in query.recentProgress))
