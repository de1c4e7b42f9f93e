"""Raw table schemas (S14) and their creation.

One row of a raw table is one document (or one page of a paged document);
the body stays semi-structured as a VARIANT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CONTENT_KEY = ["tmdb_id", "media_type"]
DOCUMENT_KEY = {"details": CONTENT_KEY, "credits": [*CONTENT_KEY, "page"]}
SLICE_KEY = ["snapshot_date", "media_type", "time_window"]

# The declared raw tables.
TRENDING_RAW = T.StructType([
    T.StructField("media_type", T.StringType()),
    T.StructField("time_window", T.StringType()),
    T.StructField("payload", T.VariantType()),
    T.StructField("snapshot_date", T.DateType()),
    T.StructField("load_ts", T.TimestampNTZType()),
])

DETAILS_RAW = T.StructType([
    T.StructField("tmdb_id", T.DecimalType(38, 0)),
    T.StructField("media_type", T.StringType()),
    T.StructField("payload", T.VariantType()),
    T.StructField("load_ts", T.TimestampNTZType()),
])

# Credits of a title may come in several pages: the page is part of the row's key,
# ``pages`` says how many the title has.
CREDITS_RAW = T.StructType(list(DETAILS_RAW.fields) + [
    T.StructField("page", T.DecimalType(38, 0)),
    T.StructField("pages", T.DecimalType(38, 0)),
])

RAW_NAMES = {"trending": "tmdb_trending_raw", "details": "tmdb_details_raw", "credits": "tmdb_credits_raw"}   # fixed values
RAW_SCHEMAS = {"trending": TRENDING_RAW, "details": DETAILS_RAW, "credits": CREDITS_RAW}


def empty_raw(spark: SparkSession, source: str) -> DataFrame:
    return spark.createDataFrame([], RAW_SCHEMAS[source])


def create_raw_tables(spark: SparkSession, database: str = "raw", replace: bool = False, location: str | None = None) -> list[str]:
    """``CREATE SCHEMA IF NOT EXISTS`` and the three raw tables, by name.

    The tables are external ones over the folders under ``location`` (default:
    the warehouse), the same that the daily job loads. A folder without a table
    gets an empty one; stored rows are kept unless ``replace=True``, which
    publishes an empty version over them. Returns the qualified names.
    """
    from snapreel.operators.replace import write_keyed
    from snapreel.sources import tables as TB
    from snapreel.sources import versions as VT
    root = (location or f"{spark.conf.get('spark.sql.warehouse.dir')}/{database}").rstrip("/")
    for source, name in RAW_NAMES.items():
        path = f"{root}/{source}"
        if replace or not VT.exists(spark, path):
            if source == "trending":
                VT.publish(empty_raw(spark, source), path, SLICE_KEY)
            else:
                write_keyed(empty_raw(spark, source), path)
        TB.attach(spark, path, f"{database}.{name}")
    return [f"{database}.{name}" for name in RAW_NAMES.values()]
