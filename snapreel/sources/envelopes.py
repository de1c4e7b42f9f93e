"""Stamp fetched API bodies into envelopes.

A fetcher yields raw API bodies (one VARIANT per response). Before they are
stored, each body is wrapped with what the response itself does not say:
the media type asked for, the time window, the load time and (trending) the
snapshot date. The clock is an argument -- pass a fixed ``load_ts`` text to
make a rerun reproducible; by default the query's current UTC time is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapreel.functions.scalars import utc_now_iso


def _text(value: str | Column | None, default: Column) -> Column:
    if value is None:
        return default
    return F.lit(value) if isinstance(value, str) else value


def stamp_trending(bodies: DataFrame, media_type: str = "all", time_window: str = "day",
                   load_ts: str | Column | None = None, body: str = "body") -> DataFrame:
    """Trending response bodies -> envelopes ``doc``.

    The envelope keeps only the body's ``results`` (``[]`` when absent), and
    ``snapshot_date`` is the UTC date of ``load_ts``.
    """
    ts = _text(load_ts, utc_now_iso())
    results = F.coalesce(F.variant_get(F.col(body), "$.results", "variant"), F.parse_json(F.lit("[]")))
    env = F.struct(F.lit(media_type).alias("media_type"), F.lit(time_window).alias("time_window"),
                   F.date_format(ts.cast("timestamp_ntz"), "yyyy-MM-dd").alias("snapshot_date"),
                   ts.alias("load_ts"), results.alias("results"))
    return bodies.select(F.to_variant_object(env).alias("doc"))


def stamp_keyed(bodies: DataFrame, tmdb_id: str = "tmdb_id", media_type: str = "media_type",
                load_ts: str | Column | None = None, body: str = "body") -> DataFrame:
    """Details / credits response bodies (with their key columns) -> envelopes ``doc``."""
    ts = _text(load_ts, utc_now_iso())
    env = F.struct(F.col(media_type).alias("media_type"), F.col(tmdb_id).alias("tmdb_id"),
                   ts.alias("load_ts"), F.col(body).alias("data"))
    return bodies.select(F.to_variant_object(env).alias("doc"))
