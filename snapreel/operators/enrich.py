"""Incremental enrichment (R2-R11) as set operations -- no key set is collected.

The run looks at the latest daily snapshot, finds the content keys whose
details / credits are not yet in the raw tables, and loads exactly those
documents. Key sets stay two-column DataFrames; the difference is an anti
join, the selection of documents a semi join, so both scale with the
cluster instead of the driver's memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapreel.functions.variant import STRING, flatten, outer, vget, vnum
from snapreel.operators.joins import broadcast_if_small, is_small

KEY = ["tmdb_id", "media_type"]
ENRICHED_TYPES = ("movie", "tv")   # fixed values: people are not enriched
DAILY_ALL = {"media_type": "all", "time_window": "day"}


def latest_snapshot(raw_trending: DataFrame) -> DataFrame:
    """R2/A1: one row, ``snapshot_date`` = newest ``all``/``day`` snapshot."""
    return (raw_trending
            .where((F.col("media_type") == DAILY_ALL["media_type"])
                   & (F.col("time_window") == DAILY_ALL["time_window"]))
            .agg(F.max("snapshot_date").alias("snapshot_date")))


def latest_trending_keys(raw_trending: DataFrame, latest_date: str | None = None) -> DataFrame:
    """Distinct (id, item media_type) of movie/tv items in the latest snapshot.

    Only the latest date is restricted to ``all``/``day``; every raw row of
    that date is flattened. The one-row latest date is broadcast (its size
    is one row by construction) and prunes the scan.
    """
    if latest_date is not None:                # known from the stored partitions' names
        rows = raw_trending.where(F.col("snapshot_date") == F.to_date(F.lit(latest_date)))
    else:
        rows = raw_trending.join(F.broadcast(latest_snapshot(raw_trending)), "snapshot_date")
    items = flatten(rows, outer("payload"), [], "item")
    return (items
            .select(vnum("item", "id").alias("tmdb_id"),
                    vget("item", "media_type", STRING).alias("media_type"))
            .where(F.col("media_type").isin(*ENRICHED_TYPES))
            .distinct())


def existing_keys(raw: DataFrame) -> DataFrame:
    """Distinct keys already present in a raw details / credits table; a
    title that comes in pages is present when all its pages are."""
    if "page" not in raw.columns:
        return raw.select(*KEY).distinct()
    held = raw.groupBy(*KEY).agg(F.count_distinct("page").alias("held"), F.max("pages").alias("pages"))
    return held.where(F.col("held") >= F.col("pages")).select(*KEY)


def missing_keys(source_keys: DataFrame, existing: DataFrame, sort: bool = False) -> DataFrame:
    """Keys in ``source_keys`` but not in ``existing`` (optionally sorted, O3).

    The source is one snapshot's keys, the existing set every key ever
    loaded. When the source passes the size check (e.g. it was staged), the
    existing set is first restricted to it by a broadcast semi join -- the
    big side is streamed, and Catalyst pushes the semi join below the
    distinct, so the loaded keys are never shuffled -- and the anti join runs
    on two small inputs. Otherwise it is one shuffled anti join.
    """
    if is_small(source_keys):
        present = existing.join(F.broadcast(source_keys), KEY, "left_semi")
        out = source_keys.join(present, KEY, "left_anti")
    else:
        out = source_keys.join(existing, KEY, "left_anti")
    return out.orderBy(*KEY) if sort else out


def missing_count(missing: DataFrame) -> DataFrame:
    """One row with the number of missing keys."""
    return missing.agg(F.count(F.lit(1)).alias("missing_count"))


def select_documents(landing: DataFrame, keys: DataFrame) -> DataFrame:
    """The landing documents (raw rows) of exactly these keys."""
    return landing.join(broadcast_if_small(keys), KEY, "left_semi")


def as_of(raw: DataFrame, cutoff) -> DataFrame:
    """The raw table as it stood before ``cutoff`` (rows with ``load_ts < cutoff``)."""
    return raw.where(F.col("load_ts") < cutoff)


def raw_complete(raw_trending: DataFrame, raw_details: DataFrame,
                 raw_credits: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """R11 as a data check: one row with missing counts and ``raw_complete``.

    Transformations may start when no latest trending key lacks details or
    credits. ``keys`` may pass the latest keys already computed (staged).
    """
    keys = keys if keys is not None else latest_trending_keys(raw_trending)
    if is_small(keys):   # scan the big raw tables against a broadcast key set
        raw_details = raw_details.join(F.broadcast(keys), KEY, "left_semi")
        raw_credits = raw_credits.join(F.broadcast(keys), KEY, "left_semi")
    d = existing_keys(raw_details).withColumn("_has_details", F.lit(True))
    c = existing_keys(raw_credits).withColumn("_has_credits", F.lit(True))
    marked = keys.join(d, KEY, "left").join(c, KEY, "left")
    out = marked.agg(
        F.count(F.lit(1)).alias("latest_keys"),
        F.count_if(F.col("_has_details").isNull()).alias("missing_details"),
        F.count_if(F.col("_has_credits").isNull()).alias("missing_credits"))
    return out.withColumn(
        "raw_complete", (F.col("missing_details") == 0) & (F.col("missing_credits") == 0))
