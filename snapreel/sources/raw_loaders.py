"""Load parsed documents into raw-table rows.

Input is a DataFrame with one VARIANT column ``doc`` holding a whole
envelope. Output rows follow :mod:`snapreel.sources.schemas`. All reads are
strict: a bad ``load_ts`` or ``tmdb_id`` raises, like the bulk load does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapreel.functions.scalars import iso_timestamp_ntz, strict_date
from snapreel.functions.variant import NUMBER, STRING, VARIANT, vget


def load_trending_raw(docs: DataFrame, snapshot_date: Column | str | None = None,
                      doc: str = "doc") -> DataFrame:
    """Envelope -> ``(media_type, time_window, payload, snapshot_date, load_ts)``.

    ``snapshot_date`` is the run's date, not the envelope's own field: pass a
    ``yyyy-MM-dd`` string or a date column (e.g. the partition column of the
    snapshot store). ``None`` falls back to the envelope's ``snapshot_date``.
    ``payload`` is the ``results`` array; a missing ``results`` flattens to
    no rows.
    """
    if snapshot_date is None:
        sd = strict_date(vget(doc, "snapshot_date", STRING))
    elif isinstance(snapshot_date, str):
        sd = strict_date(snapshot_date)
    else:
        sd = snapshot_date.cast("date")
    return docs.select(
        vget(doc, "media_type", STRING).alias("media_type"),
        vget(doc, "time_window", STRING).alias("time_window"),
        vget(doc, "results", VARIANT).alias("payload"),
        sd.alias("snapshot_date"),
        iso_timestamp_ntz(vget(doc, "load_ts", STRING)).alias("load_ts"),
    )


def _keyed_columns(doc: str) -> list[Column]:
    return [
        vget(doc, "tmdb_id", NUMBER).alias("tmdb_id"),
        vget(doc, "media_type", STRING).alias("media_type"),
        vget(doc, "data", VARIANT).alias("payload"),
        iso_timestamp_ntz(vget(doc, "load_ts", STRING)).alias("load_ts"),
    ]


def load_keyed_raw(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Details / credits envelope -> ``(tmdb_id, media_type, payload, load_ts)``."""
    return docs.select(*_keyed_columns(doc))


load_details_raw = load_keyed_raw


def load_credits_raw(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Credits envelope -> the keyed columns, ``page`` and ``pages`` (1 of 1 when not given)."""
    one = F.lit(1).cast(NUMBER)
    return docs.select(
        *_keyed_columns(doc),
        F.coalesce(vget(doc, "page", NUMBER), one).alias("page"),
        F.coalesce(vget(doc, "pages", NUMBER), one).alias("pages"))


RAW_LOADERS = {"details": load_details_raw, "credits": load_credits_raw}
