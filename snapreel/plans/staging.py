"""Staging models M1-M5: flatten raw documents into typed rows.

Each is a projection (plus at most one lateral flatten) over a raw table:
no shuffle, one whole-stage-codegen span per scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapreel.functions.scalars import try_iso_date
from snapreel.functions.variant import BOOLEAN, FLOAT, flatten, outer, vget, vnum, vstr

KEY = ["tmdb_id", "media_type"]


def stg_trending(raw_trending: DataFrame, media_type_from: str = "envelope") -> DataFrame:
    """M1 ``stg_tmdb_trending``: one row per (snapshot row, item).

    ``media_type_from='envelope'`` (default) copies the envelope's media type
    -- ``all`` for the scheduled fetch, so its rows never match details or
    credits. ``'item'`` reads each item's own ``media_type`` instead.
    """
    if media_type_from not in ("envelope", "item"):
        raise ValueError("media_type_from must be 'envelope' or 'item'")
    flat = flatten(raw_trending, outer("payload"),
                   ["snapshot_date", "load_ts", "media_type", "time_window"], "item")
    it = F.col("item")
    media_type = F.col("media_type") if media_type_from == "envelope" else vstr(it, "media_type")
    return flat.select(
        F.col("snapshot_date").alias("trending_date"),
        F.col("time_window"),
        media_type.alias("media_type"),
        vnum(it, "id").alias("tmdb_id"),
        F.coalesce(vstr(it, "title"), vstr(it, "name")).alias("title"),
        vstr(it, "original_title").alias("original_title"),
        vstr(it, "original_language").alias("original_language"),
        try_iso_date(vstr(it, "release_date")).alias("release_date"),
        vget(it, "popularity", FLOAT).alias("popularity"),
        vnum(it, "vote_count").alias("vote_count"),
        vget(it, "vote_average", FLOAT).alias("vote_average"),
        F.col("load_ts"),
        vget(it, "adult", BOOLEAN).alias("is_adult"),
        vstr(it, "original_name").alias("original_name"),
        vstr(it, "poster_path").alias("poster_path"),
        vstr(it, "backdrop_path").alias("backdrop_path"),
    )


def stg_details(raw_details: DataFrame) -> DataFrame:
    """M2 ``stg_tmdb_details``: one row per details document."""
    p = F.col("payload")
    return raw_details.select(
        "tmdb_id", "media_type",
        F.coalesce(vstr(p, "title"), vstr(p, "name")).alias("title"),
        vstr(p, "original_title").alias("original_title"),
        vstr(p, "original_language").alias("original_language"),
        F.coalesce(try_iso_date(vstr(p, "release_date")),
                   try_iso_date(vstr(p, "first_air_date"))).alias("release_date"),
        vnum(p, "runtime").alias("runtime"),
        vget(p, "vote_average", FLOAT).alias("vote_average"),
        vnum(p, "vote_count").alias("vote_count"),
        vstr(p, "imdb_id").alias("imdb_id"),
        "load_ts",
    )


def stg_details_genres(raw_details: DataFrame) -> DataFrame:
    """M3 ``stg_tmdb_details_genres``: one row per (document, genre)."""
    flat = flatten(raw_details, vget(outer("payload"), "genres"),
                   ["tmdb_id", "media_type", "load_ts"], "genre")
    g = F.col("genre")
    return flat.select("tmdb_id", "media_type",
                       vnum(g, "id").alias("genre_id"),
                       vstr(g, "name").alias("genre_name"),
                       "load_ts")


def stg_credits_cast(raw_credits: DataFrame) -> DataFrame:
    """M4 ``stg_tmdb_credits_cast``: one row per (document, cast entry)."""
    flat = flatten(raw_credits, vget(outer("payload"), "cast"),
                   ["tmdb_id", "media_type", "load_ts"], "member")
    m = F.col("member")
    return flat.select("tmdb_id", "media_type",
                       vnum(m, "id").alias("person_id"),
                       vstr(m, "name").alias("person_name"),
                       vstr(m, "character").alias("character_name"),
                       vnum(m, "order").alias("cast_order"),
                       "load_ts")


def stg_credits_crew(raw_credits: DataFrame) -> DataFrame:
    """M5 ``stg_tmdb_credits_crew``: one row per (document, crew entry)."""
    flat = flatten(raw_credits, vget(outer("payload"), "crew"),
                   ["tmdb_id", "media_type", "load_ts"], "member")
    m = F.col("member")
    return flat.select("tmdb_id", "media_type",
                       vnum(m, "id").alias("person_id"),
                       vstr(m, "name").alias("person_name"),
                       vstr(m, "department").alias("department"),
                       vstr(m, "job").alias("job"),
                       "load_ts")
