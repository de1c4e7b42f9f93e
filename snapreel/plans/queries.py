"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through the adapters) and runs over
all of their rows. Ids and counts leave as ``bigint`` so results compare
with flat SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapreel.functions.variant import STRING, vget
from snapreel.operators import enrich as E
from snapreel.operators import quality as Q
from snapreel.operators import replace as RP
from snapreel.operators import replay as R
from snapreel.plans import intermediate as I
from snapreel.plans import marts as M
from snapreel.plans import staging as S
from snapreel.plans import storage_queries
from snapreel.plans.catalog import Catalog
from snapreel.plans.shapes import flat
from snapreel.plans.storage_queries import REFETCH_DELAY_HOURS, run_cutoff
from snapreel.session import scratch_path, stage
from snapreel.sources import snapshots as SN
from snapreel.sources import versions as VT
from snapreel.sources.raw_loaders import load_trending_raw
from snapreel.streaming import load_once as X

def _cat(spark, sf_dir, **kw) -> Catalog:
    return Catalog(spark, sf_dir, **kw)


# --- marts and models -------------------------------------------------------
def fct_trending_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(_cat(spark, sf_dir).fct_trending_daily())


def stg_trending(spark, sf_dir):
    return flat(_cat(spark, sf_dir).stg_trending())


def stg_trending_item(spark, sf_dir):
    return flat(_cat(spark, sf_dir).stg_trending(media_type_from="item"))


def stg_details(spark, sf_dir):
    return flat(_cat(spark, sf_dir).stg_details)


def stg_details_genres(spark, sf_dir):
    return flat(_cat(spark, sf_dir).stg_details_genres)


def stg_credits_cast(spark, sf_dir):
    return flat(_cat(spark, sf_dir).stg_credits_cast)


def stg_credits_crew(spark, sf_dir):
    return flat(_cat(spark, sf_dir).stg_credits_crew)


def genres_summary(spark, sf_dir):
    return flat(_cat(spark, sf_dir).genres_summary)


def credits_summary(spark, sf_dir):
    return flat(_cat(spark, sf_dir).credits_summary)


def credits_summary_split(spark, sf_dir):
    """M6 with every title's names aggregated in ordered ranges (A2, A3, O4 for titles of any size)."""
    return flat(I.credits_summary_split(_cat(spark, sf_dir).raw_credits, 32))


def top_cast(spark, sf_dir):
    return flat(I.top_cast(_cat(spark, sf_dir).stg_credits_cast))


def first_director(spark, sf_dir):
    return flat(I.first_director(_cat(spark, sf_dir).stg_credits_crew))


def credits_keys(spark, sf_dir):
    c = _cat(spark, sf_dir)
    return flat(I.credits_keys(c.stg_credits_cast, c.stg_credits_crew))


def dim_content_envelope(spark, sf_dir):
    """Per-type envelopes, literal media type: the joins match."""
    return flat(_cat(spark, sf_dir).dim_content(envelope="per_type", media_type_from="envelope"))


def dim_content_all(spark, sf_dir):
    """The scheduled 'all' envelope, literal media type: no enrichment matches."""
    return flat(_cat(spark, sf_dir).dim_content(envelope="all", media_type_from="envelope"))


def dim_content_item(spark, sf_dir):
    """The 'all' envelope read with each item's own media type."""
    return flat(_cat(spark, sf_dir).dim_content(envelope="all", media_type_from="item"))


# --- incremental enrichment --------------------------------------------------
def latest_trending_keys(spark, sf_dir):
    return flat(E.latest_trending_keys(_cat(spark, sf_dir).raw_trending()))


def existing_details_keys(spark, sf_dir):
    c = _cat(spark, sf_dir)
    return flat(E.existing_keys(E.as_of(c.raw_details, run_cutoff(c))))


def existing_credits_keys(spark, sf_dir):
    c = _cat(spark, sf_dir)
    return flat(E.existing_keys(E.as_of(c.raw_credits, run_cutoff(c))))


def _missing(c: Catalog, source: str) -> DataFrame:
    raw = c.raw_details if source == "details" else c.raw_credits
    existing = E.existing_keys(E.as_of(raw, run_cutoff(c)))
    latest = stage(E.latest_trending_keys(c.raw_trending()), "latest-keys")       # its real size drives the broadcast
    return E.missing_keys(latest, existing)


def missing_keys_details(spark, sf_dir):
    return flat(_missing(_cat(spark, sf_dir, keep="raw-trending"), "details"))


def missing_keys_credits(spark, sf_dir):
    return flat(_missing(_cat(spark, sf_dir, keep="raw-trending"), "credits"))


def enrich_details(spark, sf_dir):
    """Details documents the run loads: landing documents of the missing keys."""
    c = _cat(spark, sf_dir, keep="raw")
    docs = E.select_documents(c.raw_details, _missing(c, "details"))
    return flat(docs.select("tmdb_id", "media_type",
                            F.coalesce(vget("payload", "title", STRING),
                                       vget("payload", "name", STRING)).alias("title"),
                            "load_ts"))


def enrich_credits(spark, sf_dir):
    c = _cat(spark, sf_dir, keep="raw")
    docs = E.select_documents(c.raw_credits, _missing(c, "credits"))
    people = F.size(F.variant_get("payload", "$.cast", "array<variant>"))
    titles = docs.groupBy("tmdb_id", "media_type", "load_ts").agg(
        F.sum(people).alias("cast_entries"), (F.count_distinct("page") == F.max("pages")).alias("all_pages"))
    return flat(titles)


def missing_details_count(spark, sf_dir):
    """How many latest keys have no details yet."""
    return E.missing_count(_missing(_cat(spark, sf_dir, keep="raw-trending"), "details"))


def snapshot_names(spark, sf_dir):
    """S3: the object name of every details document."""
    return _cat(spark, sf_dir).details_documents().select(SN.snapshot_file_name("details").alias("name"))


def raw_complete_gate(spark, sf_dir):
    c = _cat(spark, sf_dir)
    return E.raw_complete(c.raw_trending(), c.raw_details, c.raw_credits)


def keyed_replace(spark, sf_dir):
    """The as-of details table upserted with refetched documents of the
    latest trending keys (stamped run date + 6 h)."""
    c = _cat(spark, sf_dir)
    cutoff = run_cutoff(c)
    existing = E.as_of(c.raw_details, cutoff)
    refetched = (E.select_documents(c.raw_details, E.latest_trending_keys(c.raw_trending()))
                 .withColumn("load_ts", F.timestamp_add("HOUR", F.lit(REFETCH_DELAY_HOURS), cutoff)))
    merged = RP.upsert_by_key(existing, refetched)
    return flat(merged.select("tmdb_id", "media_type",
                              F.coalesce(vget("payload", "title", STRING),
                                         vget("payload", "name", STRING)).alias("title"),
                              "load_ts"))


# --- snapshots and replay ----------------------------------------------------
def replay_routing(spark, sf_dir):
    """R1 over every day from one before the first snapshot to two after the
    last, with 'today' the day after the last snapshot."""
    c = _cat(spark, sf_dir)
    inventory = c.trending_documents().select("snapshot_date")
    bounds = inventory.agg(F.min("snapshot_date").alias("lo"), F.max("snapshot_date").alias("hi"))
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    requested = R.date_range(spark, F.date_sub(lo, 1), F.date_add(hi, 2))
    return R.route_snapshots(requested, inventory, today=F.date_add(hi, 1))


def snapshot_roundtrip(spark, sf_dir):
    """Store every snapshot, scan it back, load the raw table with
    slice replacement twice (replay is idempotent), then build the fact."""
    c = _cat(spark, sf_dir)
    root = scratch_path(spark, "snapshot-store")
    table = scratch_path(spark, "trending-raw")
    SN.write_snapshots(c.trending_documents(), root, "trending")
    for _ in range(2):
        stored = SN.scan_snapshots(spark, root, "trending")
        RP.replace_slices(load_trending_raw(stored, snapshot_date=F.col("snapshot_date")), table)
    return flat(_fact_from_raw(VT.read(spark, table)))


def _fact_from_raw(raw: DataFrame) -> DataFrame:
    return M.fct_trending_daily(S.stg_trending(
        raw.select("media_type", "time_window", "payload", "snapshot_date", "load_ts")))


def load_once_stream(spark, sf_dir):
    """Stream the stored snapshots into the raw table twice; the second
    pass finds no new file, so the table holds every row exactly once."""
    c = _cat(spark, sf_dir)
    root = scratch_path(spark, "snapshot-store")
    table = scratch_path(spark, "trending-raw-stream")
    ckpt = scratch_path(spark, "stream-checkpoint")
    SN.write_snapshots(c.trending_documents(), root, "trending")
    X.load_new_snapshots(spark, root, table, ckpt)
    X.load_new_snapshots(spark, root, table, ckpt)
    return flat(_fact_from_raw(X.read_loaded(spark, table)))


# --- the daily job over the driver data ---------------------------------------
def _daily_marts(spark, sf_dir) -> dict:
    """Store every trending snapshot, replay the history up to two days before
    the end, preload details and credits, then run the daily job for the last
    two days (the second run takes the incremental paths). Returns its marts."""
    import datetime as dt

    from snapreel.operators.ingest import ingest_trending
    from snapreel.operators.replace import write_keyed
    from snapreel.plans import daily as D

    c = _cat(spark, sf_dir, keep="documents")
    base = scratch_path(spark, "daily-run")
    store, raw, marts = f"{base}/store", f"{base}/raw", f"{base}/marts"
    SN.write_snapshots(c.trending_documents(), store, "trending")
    dates = sorted(r.snapshot_date for r in SN.snapshot_inventory(spark, store, "trending").collect())
    today = (dates[-1] + dt.timedelta(days=1)).isoformat()
    history = spark.createDataFrame([(d,) for d in dates[:-2]], "snapshot_date date")
    ingest_trending(spark, store, f"{raw}/trending", history, today)
    write_keyed(c.raw_details, f"{raw}/details")
    write_keyed(c.raw_credits, f"{raw}/credits")
    for day in dates[-2:]:
        result = D.run_daily(spark, store, raw, marts, day.isoformat(), today=today,
                             details_landing=c.details_documents(),
                             credits_landing=c.credits_documents(), media_type_from="item",
                             allow_incomplete=True)
    return result.models


def daily_enriched_dim(spark, sf_dir):
    """The daily job with real enrichment and an interruption: details and credits
    as of the last day are preloaded; the day before the last runs whole; on the
    last day a run dies after the raw load and is repeated."""
    import datetime as dt

    from snapreel.operators.ingest import ingest_trending
    from snapreel.operators.replace import write_keyed
    from snapreel.plans import daily as D

    c = _cat(spark, sf_dir, keep="documents")
    base = scratch_path(spark, "daily-enriched")
    store, raw, marts = f"{base}/store", f"{base}/raw", f"{base}/marts"
    SN.write_snapshots(c.trending_documents(), store, "trending")
    dates = sorted(r.snapshot_date for r in SN.snapshot_inventory(spark, store, "trending").collect())
    today = (dates[-1] + dt.timedelta(days=1)).isoformat()
    day = lambda d: spark.createDataFrame([(d,)], "snapshot_date date")
    ingest_trending(spark, store, f"{raw}/trending", spark.createDataFrame([(d,) for d in dates[:-2]], "snapshot_date date"), today)
    cut = F.lit(dates[-1].isoformat()).cast("timestamp_ntz")
    write_keyed(E.as_of(c.raw_details, cut), f"{raw}/details")
    write_keyed(E.as_of(c.raw_credits, cut), f"{raw}/credits")
    run = lambda d: D.run_daily(
        spark, store, raw, marts, d.isoformat(), today=today, details_landing=c.details_documents(),
        credits_landing=c.credits_documents(), media_type_from="item", allow_incomplete=True)
    run(dates[-2])
    ingest_trending(spark, store, f"{raw}/trending", day(dates[-1]), today)
    for source, landing in (("details", c.details_documents()), ("credits", c.credits_documents())):
        D.enrich_source(spark, store, raw, source, landing, pending_root=f"{marts}/_pending")
    return flat(run(dates[-1]).models["dim_content"])


def daily_backfill_fact(spark, sf_dir):
    """A snapshot that arrives late: the next run adds its date to the stored fact."""
    import datetime as dt

    from snapreel.operators.ingest import ingest_trending
    from snapreel.plans import daily as D

    c = _cat(spark, sf_dir)
    base = scratch_path(spark, "daily-backfill")
    store, raw, marts = f"{base}/store", f"{base}/raw", f"{base}/marts"
    SN.write_snapshots(c.trending_documents(), store, "trending")
    dates = sorted(r.snapshot_date for r in SN.snapshot_inventory(spark, store, "trending").collect())
    today = (dates[-1] + dt.timedelta(days=1)).isoformat()
    late = dates[len(dates) // 2]
    days = lambda ds: spark.createDataFrame([(d,) for d in ds], "snapshot_date date")
    run = lambda d: D.run_daily(spark, store, raw, marts, d.isoformat(), today=today,
                                media_type_from="item", allow_incomplete=True)
    ingest_trending(spark, store, f"{raw}/trending", days([d for d in dates[:-2] if d != late]), today)
    run(dates[-2])
    ingest_trending(spark, store, f"{raw}/trending", days([late]), today)
    return flat(run(dates[-1]).models["fct_trending_daily"])


def daily_dim_content(spark, sf_dir):
    """``dim_content`` as stored by the daily job (incremental descriptions and
    summaries); equals the one-shot item-mode dimension."""
    return flat(_daily_marts(spark, sf_dir)["dim_content"])


def daily_fct_trending(spark, sf_dir):
    """``fct_trending_daily`` as stored by the daily job (date partitions)."""
    return flat(_daily_marts(spark, sf_dir)["fct_trending_daily"])


# --- data quality ------------------------------------------------------------
def dq_not_null(spark, sf_dir):
    return Q.run_not_null(_cat(spark, sf_dir, keep="raw").models())


def dq_unique(spark, sf_dir):
    return Q.run_unique(_cat(spark, sf_dir, keep="raw").models())


def dq_all(spark, sf_dir):
    """D1-D3 in one pass per source: all declared checks."""
    c = _cat(spark, sf_dir, keep="raw")
    return Q.run_checks(c.models(), c.raw_details, c.raw_credits)


QUERIES = {
    "fct_trending_daily": fct_trending_daily,
    "stg_trending": stg_trending,
    "stg_trending_item": stg_trending_item,
    "stg_details": stg_details,
    "stg_details_genres": stg_details_genres,
    "stg_credits_cast": stg_credits_cast,
    "stg_credits_crew": stg_credits_crew,
    "genres_summary": genres_summary,
    "credits_summary": credits_summary,
    "credits_summary_split": credits_summary_split,
    "top_cast": top_cast,
    "first_director": first_director,
    "credits_keys": credits_keys,
    "dim_content_envelope": dim_content_envelope,
    "dim_content_all": dim_content_all,
    "dim_content_item": dim_content_item,
    "latest_trending_keys": latest_trending_keys,
    "existing_details_keys": existing_details_keys,
    "existing_credits_keys": existing_credits_keys,
    "missing_keys_details": missing_keys_details,
    "missing_keys_credits": missing_keys_credits,
    "enrich_details": enrich_details,
    "enrich_credits": enrich_credits,
    "missing_details_count": missing_details_count,
    "snapshot_names": snapshot_names,
    "raw_complete_gate": raw_complete_gate,
    "keyed_replace": keyed_replace,
    "replay_routing": replay_routing,
    "snapshot_roundtrip": snapshot_roundtrip,
    "load_once_stream": load_once_stream,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_all": dq_all,
    "daily_dim_content": daily_dim_content,
    "daily_fct_trending": daily_fct_trending,
    "daily_enriched_dim": daily_enriched_dim,
    "daily_backfill_fact": daily_backfill_fact,
    **storage_queries.QUERIES,
}
