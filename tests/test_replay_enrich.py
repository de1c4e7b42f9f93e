"""Replay routing, ingest flow, missing keys, enrichment and keyed replace."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from samples import docs, keyed_env, rows, trending_env
from snapreel.operators import enrich as E
from snapreel.operators import replace as RP
from snapreel.operators import replay as R
from snapreel.operators.ingest import ingest_trending
from snapreel.sources import snapshots as SN
from snapreel.sources import versions as VT
from snapreel.sources.raw_loaders import load_details_raw, load_trending_raw


def _dates(spark, *ds):
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in ds], "snapshot_date date")


def test_routing_today_past_future(spark):
    inv = _dates(spark, "2024-03-01", "2024-03-01")
    req = _dates(spark, "2024-03-01", "2024-03-02", "2024-02-28", "2024-03-03")
    out = R.route_snapshots(req, inv, today="2024-03-02")
    assert sorted((r.requested_date.isoformat(), r.action) for r in out.collect()) == [
        ("2024-02-28", "fail"), ("2024-03-01", "replay"), ("2024-03-02", "fetch"), ("2024-03-03", "fail")]
    with pytest.raises(R.SnapshotMissingError):
        R.require_routable(out)


def test_ingest_fetches_today_and_replays(spark):
    root = tempfile.mkdtemp(prefix="snapreel-store-")
    table = tempfile.mkdtemp(prefix="snapreel-raw-") + "/t"
    SN.write_snapshots(docs(spark, trending_env([{"id": 1}], date="2024-03-01")), root, "trending")
    landing = SN.with_partition(docs(spark, trending_env([{"id": 2}], date="2024-03-02")), "trending")
    routes = ingest_trending(spark, root, table, _dates(spark, "2024-03-01", "2024-03-02"),
                             "2024-03-02", landing)
    assert sorted(r.action for r in routes.collect()) == ["fetch", "replay"]
    # rerun: both dates are now stored, nothing is duplicated
    ingest_trending(spark, root, table, _dates(spark, "2024-03-01", "2024-03-02"), "2024-03-03")
    assert VT.read(spark, table).count() == 2
    with pytest.raises(R.SnapshotMissingError):
        ingest_trending(spark, root, table, _dates(spark, "2024-02-01"), "2024-03-03")


def _raw_trending(spark):
    return load_trending_raw(docs(spark,
        trending_env([{"id": 1, "media_type": "movie"}], date="2024-03-01"),
        trending_env([{"id": 1, "media_type": "movie"}, {"id": 2, "media_type": "tv"},
                      {"id": 3, "media_type": "person"}, {"id": 4, "media_type": "movie"}],
                     date="2024-03-02"),
        trending_env([{"id": 99, "media_type": "movie"}], date="2024-03-09", window="week")))


def test_latest_keys_exclude_people_and_older_dates(spark):
    out = E.latest_trending_keys(_raw_trending(spark))
    assert rows(out, "tmdb_id", "media_type") == [(1, "movie"), (2, "tv"), (4, "movie")]


def test_missing_keys_and_enrichment(spark):
    existing = load_details_raw(docs(spark, keyed_env(1, "movie", {"title": "One"}),
                                     keyed_env(2, "movie", {"title": "Wrong type"})))
    landing = load_details_raw(docs(spark, keyed_env(2, "tv", {"name": "Two"}),
                                    keyed_env(4, "movie", {"title": "Four"}),
                                    keyed_env(5, "movie", {"title": "Five"})))
    keys = E.latest_trending_keys(_raw_trending(spark))
    missing = E.missing_keys(keys, E.existing_keys(existing), sort=True)
    assert [(int(r.tmdb_id), r.media_type) for r in missing.collect()] == [(2, "tv"), (4, "movie")]
    # property: nothing missing is already present
    assert missing.join(E.existing_keys(existing), E.KEY, "left_semi").count() == 0
    loaded = E.select_documents(landing, missing)
    assert rows(loaded, "tmdb_id", "media_type") == [(2, "tv"), (4, "movie")]
    after = existing.unionByName(loaded)
    gate = E.raw_complete(_raw_trending(spark), after, after).collect()[0]
    assert gate.missing_details == 0 and gate.raw_complete


def test_upsert_by_key(spark):
    old = load_details_raw(docs(spark, keyed_env(1, "movie", {"title": "A"}),
                                keyed_env(2, "movie", {"title": "B"})))
    new = load_details_raw(docs(spark, keyed_env(2, "movie", {"title": "B2"}),
                                keyed_env(3, "tv", {"name": "C"})))
    out = RP.upsert_by_key(old, new).select("tmdb_id", F.expr("variant_get(payload, '$.title', 'string')").alias("t"))
    assert rows(out, "tmdb_id", "t") == [(1, "A"), (2, "B2"), (3, None)]


def test_upsert_keyed_table_rewrites_only_touched_buckets(spark):
    path = tempfile.mkdtemp(prefix="snapreel-keyed-") + "/details"
    old = load_details_raw(docs(spark, *[keyed_env(i, "movie", {"title": f"v1-{i}"}) for i in range(20)]))
    RP.write_keyed(old, path, buckets=8)
    new = load_details_raw(docs(spark, keyed_env(3, "movie", {"title": "v2-3"}),
                                keyed_env(100, "tv", {"name": "v2-100"})))
    for _ in range(2):  # idempotent
        RP.upsert_keyed_table(spark, path, new)
    t = RP.read_keyed(spark, path).select(
        "tmdb_id", F.expr("coalesce(variant_get(payload,'$.title','string'), variant_get(payload,'$.name','string'))").alias("t"))
    got = dict((int(r.tmdb_id), r.t) for r in t.collect())
    assert len(got) == 21 and t.count() == 21
    assert got[3] == "v2-3" and got[100] == "v2-100" and got[4] == "v1-4"


def test_bucket_count_is_recorded_and_reused(spark):
    path = tempfile.mkdtemp(prefix="snapreel-layout-") + "/credits"
    rows = load_details_raw(docs(spark, *[keyed_env(i, "movie", {"title": f"t{i}"}) for i in range(10)]))
    RP.write_keyed(rows, path)
    assert RP.table_buckets(spark, path) == RP.choose_buckets(rows)   # recorded as chosen
    sup = spark.read.parquet("/root/testdata/sf0.001/supplier.parquet")
    assert RP.choose_buckets(sup) == RP.MIN_BUCKETS   # a small, well-estimated input
    RP.write_keyed(rows, path, buckets=32)           # a full rewrite replaces every bucket
    assert RP.table_buckets(spark, path) == 32
    assert RP.read_keyed(spark, path).select("key_bucket").distinct().count() <= 32
    new = load_details_raw(docs(spark, keyed_env(3, "movie", {"title": "new"})))
    RP.upsert_keyed_table(spark, path, new)          # uses the recorded 32 buckets
    t = RP.read_keyed(spark, path)
    assert t.count() == 10
    assert t.where("tmdb_id = 3").select("key_bucket").distinct().count() == 1
