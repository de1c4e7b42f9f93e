"""Registered queries of the stored side: published versions, key index, stored documents.

Each one builds its tables from the driver's, puts them through storage -- runs
that die included -- and returns what a reader then finds.
"""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapreel.functions.scalars import utc_today_iso
from snapreel.functions.variant import STRING, vget
from snapreel.operators import enrich as E
from snapreel.operators import keyindex as KI
from snapreel.operators import replace as RP
from snapreel.operators import replay as R
from snapreel.operators.ingest import ingest_trending
from snapreel.plans import daily as D
from snapreel.plans import marts as M
from snapreel.plans import staging as S
from snapreel.plans.catalog import Catalog
from snapreel.plans.shapes import flat
from snapreel.session import scratch_path, stage
from snapreel.sources import envelopes as EN
from snapreel.sources import snapshots as SN
from snapreel.sources import versions as VT
from snapreel.sources.raw_loaders import load_trending_raw
from snapreel.sources.schemas import create_raw_tables
from snapreel.streaming import keyed_load as KL
from snapreel.streaming import load_once as X

DIED = (PySparkException, Py4JJavaError)     # a job that failed, told by one of its exceptions
REFETCH_DELAY_HOURS = 6  # fixed value: refetched documents are stamped run date + 6 h


def run_cutoff(c: Catalog):
    """Start of the latest snapshot day: raw rows loaded before it already existed."""
    latest = E.latest_snapshot(c.raw_trending())
    return latest.select(F.col("snapshot_date").cast("timestamp_ntz")).scalar()


def _titled(raw: DataFrame) -> DataFrame:
    title = F.coalesce(vget("payload", "title", STRING), vget("payload", "name", STRING))
    return flat(raw.select("tmdb_id", "media_type", title.alias("title"), "load_ts"))


# --- published versions (S13, S17) ----------------------------------------------
def stored_replace_after_crash(spark, sf_dir):
    """The as-of details as a keyed table; its rewrite into four times the buckets dies on
    one of its rows, and so does an upsert; then the refetched documents are upserted."""
    c = Catalog(spark, sf_dir, keep="raw")
    cutoff, path = run_cutoff(c), scratch_path(spark, "details-crash")
    RP.write_keyed(E.as_of(c.raw_details, cutoff), path)
    fresh = (E.select_documents(c.raw_details, E.latest_trending_keys(c.raw_trending()))
             .withColumn("load_ts", F.timestamp_add("HOUR", F.lit(REFETCH_DELAY_HOURS), cutoff)))

    def dying(rows):
        last = rows.agg(F.max("tmdb_id")).first()[0]
        dies = F.when(F.col("tmdb_id") == F.lit(last), F.raise_error(F.lit("killed")).cast("string"))
        return rows.withColumn("media_type", dies.otherwise(F.col("media_type")))

    stored = RP.read_keyed(spark, path).drop("key_bucket")
    for write in (lambda: RP.write_keyed(dying(stored), path, 4 * RP.table_buckets(spark, path)),
                  lambda: VT.publish(dying(fresh).withColumn("key_bucket", F.lit(0)), path, ["key_bucket"], {"key_bucket=0"})):
        try:
            write()
        except DIED:
            continue
    RP.upsert_keyed_table(spark, path, fresh)
    return _titled(RP.read_keyed(spark, path))


# --- tables by name (S14, S15) ----------------------------------------------------
def raw_tables_by_name(spark, sf_dir):
    """The raw tables are declared, loaded by the job's writers and read by name in SQL."""
    c = Catalog(spark, sf_dir)
    root, database = scratch_path(spark, "raw-named"), "raw_" + uuid.uuid4().hex[:8]
    create_raw_tables(spark, database, location=root)
    RP.replace_slices(c.raw_trending(), f"{root}/trending")
    KI.load(spark, root, "details", c.raw_details)
    KI.load(spark, root, "credits", c.raw_credits)
    trending, details, credits = create_raw_tables(spark, database, location=root)
    return spark.sql(f"""
        SELECT CAST(d.tmdb_id AS BIGINT) AS tmdb_id, d.media_type, d.load_ts, c.pages,
               (SELECT count(DISTINCT snapshot_date) FROM {trending} WHERE media_type = 'all') AS days
        FROM {details} d
        LEFT JOIN (SELECT tmdb_id, media_type, count(*) AS pages FROM {credits} GROUP BY ALL) c
          ON c.tmdb_id = d.tmdb_id AND c.media_type = d.media_type""")


def copartitioned_dim(spark, sf_dir):
    """Descriptions, details and summaries are stored clustered alike, upserted once, and joined by name."""
    c = Catalog(spark, sf_dir, keep="raw")
    marts, database = scratch_path(spark, "marts-clustered"), "marts_" + uuid.uuid4().hex[:8]
    raw = {"details": c.raw_details, "credits": c.raw_credits}
    st, even = c.stg_trending(media_type_from="item"), F.col("tmdb_id") % 2 == 0
    early = {s: df.where(even) for s, df in raw.items()}
    D.refresh_inputs(spark, early, marts, {}, st, None, "item")
    loaded = {s: stage(df.where(~even).select(*E.KEY).distinct(), f"loaded-{s}") for s, df in raw.items()}
    days = [r[0].isoformat() for r in st.select("trending_date").distinct().collect()]
    paths, _ = D.refresh_inputs(spark, raw, marts, loaded, st, days, "item")
    return flat(D.dim_from_inputs(D.named_inputs(spark, paths, database)))


# --- key index (R4-R6, J8) -------------------------------------------------------
def _indexed_missing(spark, sf_dir, source):
    """The as-of documents come in two loads; what the latest keys lack is found in the key index alone."""
    c = Catalog(spark, sf_dir, keep="raw")
    raw, cutoff = scratch_path(spark, "raw-indexed"), run_cutoff(c)
    known = E.as_of(c.raw_details if source == "details" else c.raw_credits, cutoff)
    early = F.col("load_ts") < F.timestamp_add("DAY", F.lit(-10), cutoff)
    for rows in (known.where(early), known.where(~early)):
        KI.load(spark, raw, source, rows)
    return flat(E.missing_keys(E.latest_trending_keys(c.raw_trending()), E.existing_keys(KI.loaded_keys(spark, raw, source))))


def indexed_missing_details(spark, sf_dir):
    return _indexed_missing(spark, sf_dir, "details")


def indexed_missing_credits(spark, sf_dir):
    return _indexed_missing(spark, sf_dir, "credits")


def missing_keys_sorted(spark, sf_dir):
    """O3: the missing keys in their total order, with the place each has in it."""
    c = Catalog(spark, sf_dir)
    existing = E.existing_keys(E.as_of(c.raw_details, run_cutoff(c)))
    ordered = E.missing_keys(E.latest_trending_keys(c.raw_trending()), existing, sort=True)
    placed = ordered.withColumn("at", F.monotonically_increasing_id())          # rises along the sorted output
    return flat(placed.select(*E.KEY, F.row_number().over(Window.orderBy("at")).cast("bigint").alias("place")))


def latest_keys_of_mixed_snapshots(spark, sf_dir):
    """R2/R3 over raw rows that are not all ``all``/``day``: the last day is stored for the week
    window only, the day before for single media types, so the day before that is the latest."""
    c = Catalog(spark, sf_dir)
    plain, single = c.trending_documents(), c.trending_documents("per_type")
    weekly = c.trending_documents(time_window="week")
    days = sorted(r[0] for r in plain.select("snapshot_date").distinct().collect())
    raw = load_trending_raw(
        plain.where(F.col("snapshot_date") < F.lit(days[-2]))
        .unionByName(single.where(F.col("snapshot_date") == F.lit(days[-2])))
        .unionByName(weekly.where(F.col("snapshot_date") == F.lit(days[-1]))))
    return flat(E.latest_trending_keys(raw))


# --- stored documents (S4, S6, S7, S8, F10) --------------------------------------
def _fact(raw: DataFrame) -> DataFrame:
    return flat(M.fct_trending_daily(S.stg_trending(raw)))


def stamped_fact(spark, sf_dir):
    """Response bodies stamped with media type, window and a given load time, stored and loaded."""
    c = Catalog(spark, sf_dir)
    bodies = c.trending_documents().select(F.to_variant_object(F.struct(vget("doc", "results").alias("results"))).alias("body"),
                                           vget("doc", "load_ts", STRING).alias("at"))
    root = scratch_path(spark, "stamped")
    SN.write_snapshots(EN.stamp_trending(bodies, "all", "day", load_ts=F.col("at")), root, "trending")
    return _fact(load_trending_raw(SN.scan_snapshots(spark, root, "trending")))


def stamped_now(spark, sf_dir):
    """The same bodies stamped with the query's own clock; their snapshot date is today's."""
    c = Catalog(spark, sf_dir)
    bodies = c.trending_documents().select(F.to_variant_object(F.struct(vget("doc", "results").alias("results"))).alias("body"))
    raw = load_trending_raw(EN.stamp_trending(bodies))
    fact = S.stg_trending(raw).where(F.col("trending_date").cast("string") == utc_today_iso())
    return flat(fact.select("trending_date", F.to_date("load_ts").alias("load_date"), "tmdb_id", "popularity"))


def routing_today(spark, sf_dir):
    """R1 with F10's clock: every stored date is replayed, today is fetched, tomorrow cannot be had."""
    inventory = Catalog(spark, sf_dir).trending_documents().select("snapshot_date")
    today = F.to_date(utc_today_iso())
    asked = inventory.distinct().unionByName(spark.range(1).select(today.alias("snapshot_date"))).unionByName(
        spark.range(1).select(F.date_add(today, 1).alias("snapshot_date")))
    return R.route_snapshots(asked, inventory, today=today)


def named_documents(spark, sf_dir):
    """A store in which files of another name lie beside the snapshots; the scan takes them by name."""
    c = Catalog(spark, sf_dir)
    root = scratch_path(spark, "named")
    path = SN.write_snapshots(c.trending_documents(), root, "trending")
    notes = c.table("events").select(F.concat(F.lit("not a document: "), "props").alias("value"), F.to_date("ts").alias("snapshot_date"))
    notes.write.mode("append").option("compression", "gzip").partitionBy("snapshot_date").text(path)
    return _fact(load_trending_raw(SN.scan_snapshots(spark, root, "trending", name_regex=r"\.txt$"), snapshot_date=F.col("snapshot_date")))


def repaired_documents(spark, sf_dir):
    """Every title ends in a byte that is no UTF-8; documents are stored so and repaired when read."""
    c = Catalog(spark, sf_dir)
    text = F.to_json("doc")
    marked = F.regexp_replace(text, '"(title|name)":"([^"]*)"', '"$1":"$2\x1a"')
    raw_bytes = F.array_join(F.transform(F.split(marked, "\x1a"), lambda s: F.hex(s.cast("binary"))), "FF")
    broken = c.trending_documents().select(F.unhex(raw_bytes).cast("string").alias("value"), "snapshot_date")
    root = scratch_path(spark, "broken")
    broken.write.partitionBy("snapshot_date").text(SN.source_path(root, "trending"))
    raw = load_trending_raw(SN.scan_snapshots(spark, root, "trending"), snapshot_date=F.col("snapshot_date"))
    return flat(S.stg_trending(raw).select("trending_date", "tmdb_id", "title"))


def malformed_load(spark, sf_dir):
    """The last day's documents are cut short; loading that day aborts and leaves the raw table as it was."""
    c = Catalog(spark, sf_dir)
    root, table = scratch_path(spark, "malformed"), scratch_path(spark, "malformed-raw")
    text = F.to_json("doc")
    days = c.trending_documents().select(text.alias("value"), "snapshot_date")
    last = days.agg(F.max("snapshot_date")).scalar()
    half = F.expr("substring(value, 1, length(value) div 2)")
    days.withColumn("value", F.when(F.col("snapshot_date") == last, half).otherwise(F.col("value"))).write.partitionBy("snapshot_date").text(
        SN.source_path(root, "trending"))
    dates = sorted(r.snapshot_date for r in SN.snapshot_inventory(spark, root, "trending").collect())
    asked = lambda ds: spark.createDataFrame([(d,) for d in ds], "snapshot_date date")
    today = (dates[-1] + dt.timedelta(days=1)).isoformat()
    ingest_trending(spark, root, table, asked(dates[:-1]), today)
    try:
        ingest_trending(spark, root, table, asked(dates[-2:]), today)
    except DIED:
        return _fact(VT.read(spark, table))
    raise AssertionError("a malformed document was loaded")


# --- streams (X1) ------------------------------------------------------------------
def redelivered_stream(spark, sf_dir):
    """Every stored document comes a second time under another file name; the stream's state drops it."""
    c = Catalog(spark, sf_dir)
    root, table, log = (scratch_path(spark, n) for n in ("redelivered", "redelivered-raw", "redelivered-log"))
    path = SN.write_snapshots(c.trending_documents(), root, "trending")
    X.load_new_snapshots(spark, root, table, log, redelivery_window="30 days")
    again = spark.read.option("basePath", path).text(path)
    stage(again, "redelivery").write.mode("append").partitionBy("snapshot_date").text(path)
    X.load_new_snapshots(spark, root, table, log, redelivery_window="30 days")
    return _fact(X.read_loaded(spark, table))


def streamed_keyed_load(spark, sf_dir):
    """X1 + S13: the as-of details are streamed into their keyed table, then the refetched ones; that
    run dies after its rows are published, and its repetition is handed the batch again."""
    c = Catalog(spark, sf_dir, keep="raw")
    cutoff = run_cutoff(c)
    root, raw, log = (scratch_path(spark, n) for n in ("streamed", "streamed-raw", "streamed-log"))
    refetched = (E.select_documents(c.raw_details, E.latest_trending_keys(c.raw_trending()))
                 .withColumn("load_ts", F.timestamp_add("HOUR", F.lit(REFETCH_DELAY_HOURS), cutoff)))

    def store(rows):
        envelope = F.struct("media_type", "tmdb_id", F.col("load_ts").cast("string").alias("load_ts"), F.col("payload").alias("data"))
        SN.write_snapshots(rows.select(F.to_variant_object(envelope).alias("doc")), root, "details")

    def die(number):
        raise InterruptedError("killed")

    store(E.as_of(c.raw_details, cutoff))
    KL.load_new_documents(spark, root, raw, "details", log)
    store(refetched)
    try:
        KL.load_new_documents(spark, root, raw, "details", log, after_batch=die)
    except StreamingQueryException:
        KL.load_new_documents(spark, root, raw, "details", log)
    return _titled(D.read_raw(spark, raw, "details"))


# --- barrier (R11) ---------------------------------------------------------------
def gated_daily_dim(spark, sf_dir):
    """R11 enforced: the daily job refuses to build marts while details and credits lack a latest key,
    and builds them once every trending title has been fetched (titles are named by their key)."""
    c = Catalog(spark, sf_dir)
    base = scratch_path(spark, "gated")
    store, raw, marts = f"{base}/store", f"{base}/raw", f"{base}/marts"
    SN.write_snapshots(c.trending_documents(), store, "trending")
    dates = sorted(r.snapshot_date for r in SN.snapshot_inventory(spark, store, "trending").collect())
    today = (dates[-1] + dt.timedelta(days=1)).isoformat()
    titles = S.stg_trending(c.raw_trending(), "item").where(F.col("media_type").isin(*E.ENRICHED_TYPES)).select("tmdb_id", "media_type").distinct()
    name = F.concat_ws(" ", F.lit("Title"), "media_type", F.col("tmdb_id").cast("string"))
    person = F.struct(F.col("tmdb_id").alias("id"), F.concat(F.lit("Director of "), F.col("tmdb_id").cast("string")).alias("name"),
                      F.lit("Director").alias("job"))
    bodies = {"details": F.struct(name.alias("title")), "credits": F.struct(F.array(person).alias("crew"))}
    landing = {f"{s}_landing": EN.stamp_keyed(titles.select("tmdb_id", "media_type", F.to_variant_object(b).alias("body")), load_ts=f"{today}T00:00:00+00:00")
               for s, b in bodies.items()}
    run = lambda day, **kw: D.run_daily(spark, store, raw, marts, day.isoformat(), today=today, media_type_from="item", **kw)
    try:
        run(dates[-2], details_landing=landing["details_landing"])
        raise AssertionError("marts were built without credits")
    except D.RawIncompleteError:
        run(dates[-2], **landing)
    return flat(run(dates[-1], **landing).models["dim_content"])


QUERIES = {f.__name__: f for f in (
    stored_replace_after_crash, raw_tables_by_name, copartitioned_dim, indexed_missing_details, indexed_missing_credits, missing_keys_sorted, latest_keys_of_mixed_snapshots,
    redelivered_stream, streamed_keyed_load, stamped_fact, stamped_now, routing_today, named_documents, repaired_documents, malformed_load, gated_daily_dim)}
