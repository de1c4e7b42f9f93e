"""The daily job end to end on hand-written landing documents."""

import tempfile

from pyspark.sql import functions as F

from samples import docs, keyed_env, trending_env  # noqa: F401
from snapreel.plans import daily as D
from snapreel.session import shared_dir
from snapreel.sources import versions as VT


def test_daily_run_enriches_missing_keys_once(spark):
    shared_dir(spark)
    base = tempfile.mkdtemp(prefix="snapreel-daily-")
    store, raw, marts = f"{base}/store", f"{base}/raw", f"{base}/marts"
    details = docs(spark, keyed_env(1, "movie", {"title": "One (details)", "runtime": 90}),
                   keyed_env(2, "tv", {"name": "Two (details)"}),
                   keyed_env(9, "movie", {"title": "Not trending"}))
    credits = docs(spark, keyed_env(1, "movie", {"crew": [{"id": 5, "name": "Dee", "job": "Director"}]}))
    # the scheduled fetch: one 'all'/'day' envelope
    trending = docs(spark, trending_env([{"id": 1, "media_type": "movie", "title": "One"},
                                         {"id": 2, "media_type": "tv", "name": "Two"},
                                         {"id": 3, "media_type": "person", "name": "P"}],
                                        date="2024-03-02"))
    r = D.run_daily(spark, store, raw, marts, "2024-03-02", today="2024-03-02",
                    trending_landing=trending, details_landing=details, credits_landing=credits,
                    media_type_from="item", allow_incomplete=True)      # title 2 has no credits
    assert [x.action for x in r.routes.collect()] == ["fetch"]
    gate = r.gate.collect()[0]
    assert (gate.latest_keys, gate.missing_details, gate.missing_credits) == (2, 0, 1)
    dim = {int(x.tmdb_id): x for x in r.models["dim_content"].collect()}
    assert dim[1].title == "One (details)" and dim[1].director_name == "Dee"
    assert dim[2].title == "Two (details)" and dim[3].media_type == "person"
    assert D.read_raw(spark, raw, "details").count() == 2   # key 9 is not trending
    # rerun of the same day: replay, nothing new to enrich, no duplicates
    r2 = D.run_daily(spark, store, raw, marts, "2024-03-02", today="2024-03-02",
                     details_landing=details, credits_landing=credits, media_type_from="item",
                     allow_incomplete=True)
    assert [x.action for x in r2.routes.collect()] == ["replay"]
    assert D.read_raw(spark, raw, "details").count() == 2
    assert D.read_raw(spark, raw, "trending").count() == 1
    fails = {x.model: x.failing_groups for x in r2.unique.collect()}
    assert fails["dim_content"] == 0 and fails["tmdb_details_raw"] == 0
    assert r2.not_null.where(F.col("failing_rows") > 0).count() == 0


def test_fact_rebuilds_only_given_dates(spark):
    base = tempfile.mkdtemp(prefix="snapreel-fact-")
    from snapreel.sources.raw_loaders import load_trending_raw
    day = lambda d, ids: load_trending_raw(docs(spark, trending_env([{"id": i} for i in ids], date=d)))
    first = day("2024-03-01", [1, 2]).unionByName(day("2024-03-02", [3]))
    m = D.materialize_marts(spark, D.build_models(first, _empty_keyed(spark), _empty_keyed(spark)), base)
    assert m["fct_trending_daily"].count() == 3
    # the 2024-03-02 slice is replaced; only that date is recomputed and rewritten
    second = day("2024-03-01", [1, 2]).unionByName(day("2024-03-02", [4, 5]))
    m = D.materialize_marts(spark, D.build_models(second, _empty_keyed(spark), _empty_keyed(spark)), base,
                            fact_dates=["2024-03-02"])
    got = sorted((r.trending_date.isoformat(), int(r.tmdb_id)) for r in m["fct_trending_daily"].collect())
    assert got == [("2024-03-01", 1), ("2024-03-01", 2), ("2024-03-02", 4), ("2024-03-02", 5)]


def _empty_keyed(spark):
    return D.read_raw(spark, "/nonexistent-snapreel", "details")


def test_full_fact_rebuild_drops_vanished_dates(spark):
    from snapreel.sources.raw_loaders import load_trending_raw
    base = tempfile.mkdtemp(prefix="snapreel-fact-")
    day = lambda d, ids: load_trending_raw(docs(spark, trending_env([{"id": i} for i in ids], date=d)))
    D.materialize_marts(spark, D.build_models(day("2024-03-01", [1]).unionByName(day("2024-03-02", [2])),
                                              _empty_keyed(spark), _empty_keyed(spark)), base)
    m = D.materialize_marts(spark, D.build_models(day("2024-03-02", [2]), _empty_keyed(spark),
                                                  _empty_keyed(spark)), base)
    assert [r.trending_date.isoformat() for r in m["fct_trending_daily"].collect()] == ["2024-03-02"]


def test_incremental_descriptions_equal_full_rebuild(spark):
    from snapreel.plans import marts as M
    from snapreel.plans import staging as S
    from snapreel.sources.raw_loaders import load_trending_raw
    base = tempfile.mkdtemp(prefix="snapreel-desc-")
    day = lambda d, items: load_trending_raw(docs(spark, trending_env(items, date=d)))
    d1 = day("2024-03-01", [{"id": 1, "title": "A"}, {"id": 2, "name": "B"}])          # NULL columns
    d2 = day("2024-03-02", [{"id": 1, "title": "A"}, {"id": 1, "title": "A2"}, {"id": 2, "name": "B"}])
    path = f"{base}/desc"
    D.update_descriptions(spark, path, S.stg_trending(d1), dates=["2024-03-01"])
    both = S.stg_trending(d1.unionByName(d2))
    for _ in range(2):  # rerun adds nothing
        D.update_descriptions(spark, path, both, dates=["2024-03-02"])
    got = VT.read(spark, path).drop("key_bucket")
    want = M.trending_descriptions(both)
    assert got.count() == want.count() == 3
    assert got.exceptAll(want).count() == 0


def test_incremental_summaries_equal_full_recompute(spark):
    from snapreel.plans import intermediate as I
    from snapreel.plans import staging as S
    shared_dir(spark)
    base = tempfile.mkdtemp(prefix="snapreel-inc-")
    store, raw, marts = f"{base}/store", f"{base}/raw", f"{base}/marts"
    credits = docs(spark,
                   keyed_env(1, "movie", {"cast": [{"id": 1, "name": "A", "order": 0}],
                                          "crew": [{"id": 2, "name": "D1", "job": "Director"}]}),
                   keyed_env(4, "movie", {"cast": [{"id": 3, "name": "C", "order": 1}, {"id": 4, "name": "B", "order": 0}],
                                          "crew": [{"id": 5, "name": "D4", "job": "Director"}]}))
    details = docs(spark, keyed_env(1, "movie", {"title": "One", "genres": [{"id": 1, "name": "Drama"}]}),
                   keyed_env(4, "movie", {"title": "Four", "genres": [{"id": 2, "name": "War"}, {"id": 1, "name": "Drama"}]}))
    for day, ids in (("2024-03-01", [1]), ("2024-03-02", [1, 4])):
        trending = docs(spark, trending_env([{"id": i, "media_type": "movie", "title": f"T{i}"} for i in ids], date=day))
        r = D.run_daily(spark, store, raw, marts, day, today=day, trending_landing=trending,
                        details_landing=details, credits_landing=credits, media_type_from="item", allow_incomplete=True)
    raw_c, raw_d = D.read_raw(spark, raw, "credits"), D.read_raw(spark, raw, "details")
    full_c = I.credits_summary(S.stg_credits_cast(raw_c), S.stg_credits_crew(raw_c))
    full_g = I.genres_summary(S.stg_details_genres(raw_d))
    inc_c, inc_g = r.models["int_tmdb_credits_summary"], r.models["int_tmdb_genres_summary"]
    assert inc_c.count() == full_c.count() == 2
    assert inc_c.select(full_c.columns).exceptAll(full_c).count() == 0
    assert inc_g.select(full_g.columns).exceptAll(full_g).count() == 0
    dim = {int(x.tmdb_id): x for x in r.models["dim_content"].collect()}
    assert (dim[4].title, dim[4].director_name, dim[4].top_cast, dim[4].genres) == ("Four", "D4", "B, C", "Drama, War")


def test_daily_run_on_driver_data_equals_one_shot_models(spark):
    """History replayed day by day + one daily run == the models built in one shot."""
    import datetime as dt
    from samples import SF_SMALL
    from snapreel.operators.ingest import ingest_trending
    from snapreel.operators.replace import write_keyed
    from snapreel.plans.catalog import Catalog
    from snapreel.plans.queries import flat
    from snapreel.sources import snapshots as SN
    shared_dir(spark)
    base = tempfile.mkdtemp(prefix="snapreel-hist-")
    store, raw, marts = f"{base}/store", f"{base}/raw", f"{base}/marts"
    cat = Catalog(spark, SF_SMALL)
    SN.write_snapshots(cat.trending_documents(), store, "trending")
    dates = sorted(r.snapshot_date for r in SN.snapshot_inventory(spark, store, "trending").collect())
    history = spark.createDataFrame([(d,) for d in dates[:-2]], "snapshot_date date")
    ingest_trending(spark, store, f"{raw}/trending", history, dates[-1].isoformat())
    write_keyed(cat.raw_details, f"{raw}/details")
    write_keyed(cat.raw_credits, f"{raw}/credits")
    for day in dates[-2:]:   # the second run takes the incremental paths
        r = D.run_daily(spark, store, raw, marts, day.isoformat(),
                        today=(dates[-1] + dt.timedelta(days=1)).isoformat(),
                        details_landing=cat.details_documents(), credits_landing=cat.credits_documents(),
                        media_type_from="item", allow_incomplete=True)
        assert [x.action for x in r.routes.collect()] == ["replay"]
    want_dim = flat(cat.dim_content(media_type_from="item"))
    got_dim = flat(r.models["dim_content"]).select(*want_dim.columns)
    assert got_dim.count() == want_dim.count()
    assert got_dim.exceptAll(want_dim).count() == 0
    from snapreel.plans import marts as M
    want_fct = flat(M.fct_trending_daily(cat.stg_trending(media_type_from="item")))
    got_fct = flat(r.models["fct_trending_daily"]).select(*want_fct.columns)
    assert got_fct.count() == want_fct.count()
    assert got_fct.exceptAll(want_fct).count() == 0 and want_fct.exceptAll(got_fct).count() == 0


def test_scoped_checks_find_new_faults_and_skip_old_data(spark):
    from snapreel.operators import quality as Q
    bad_old = docs(spark, trending_env([{"id": None, "title": "old fault"}], date="2024-03-01"))
    new = docs(spark, trending_env([{"id": 5}], date="2024-03-02"))          # NULL title: new fault
    from snapreel.sources.raw_loaders import load_trending_raw
    raw_t = load_trending_raw(bad_old).unionByName(load_trending_raw(new))
    models = D.build_models(raw_t, _empty_keyed(spark), _empty_keyed(spark))
    checked = {**models, "tmdb_details_raw": _empty_keyed(spark).drop("payload"),
               "tmdb_credits_raw": _empty_keyed(spark).drop("payload")}
    scoped = D.scope_checks(checked, ["2024-03-02"], {})
    nn = {(r.model, r.column_name): r.failing_rows for r in Q.run_not_null(scoped).collect()}
    assert nn[("stg_tmdb_trending", "title")] == 1 and nn[("stg_tmdb_trending", "tmdb_id")] == 0
    assert ("stg_tmdb_details", "tmdb_id") not in nn        # nothing new there: left out, not passed
    full = {(r.model, r.column_name): r.failing_rows for r in Q.run_not_null(checked).collect()}
    assert full[("stg_tmdb_trending", "tmdb_id")] == 1


def test_enrichment_rerun_after_crash_between_store_and_load(spark):
    """Documents stored but not loaded (a crash): the rerun loads them without failing."""
    from snapreel.operators.ingest import ingest_trending
    from snapreel.sources import snapshots as SN
    shared_dir(spark)
    base = tempfile.mkdtemp(prefix="snapreel-crash-")
    store, raw = f"{base}/store", f"{base}/raw"
    trending = docs(spark, trending_env([{"id": 1, "media_type": "movie", "title": "One"}], date="2024-03-02"))
    dates = spark.createDataFrame([(__import__("datetime").date(2024, 3, 2),)], "snapshot_date date")
    ingest_trending(spark, store, f"{raw}/trending", dates, "2024-03-02", SN.with_partition(trending, "trending"))
    details = docs(spark, keyed_env(1, "movie", {"title": "One (details)"}))
    SN.write_snapshots(details, store, "details")            # stored, then the job died
    missing, touched = D.enrich_source(spark, store, raw, "details", details)
    assert touched.count() == 1
    assert D.read_raw(spark, raw, "details").count() == 1
    assert SN.scan_snapshots(spark, store, "details").count() == 1   # not stored twice


def test_uncommitted_first_build_is_rebuilt(spark):
    """A descriptions folder left by a crashed first build is rebuilt in full, not appended to."""
    import os
    from snapreel.plans import staging as S
    from snapreel.sources.raw_loaders import load_trending_raw
    base = tempfile.mkdtemp(prefix="snapreel-uncommitted-")
    path = f"{base}/desc"
    os.makedirs(f"{path}/_temporary/0")                       # what a dead job leaves behind
    day = lambda d, ids: load_trending_raw(docs(spark, trending_env([{"id": i} for i in ids], date=d)))
    st = S.stg_trending(day("2024-03-01", [1]).unionByName(day("2024-03-02", [2])))
    D.update_descriptions(spark, path, st, dates=["2024-03-02"])
    got = VT.read(spark, path)
    assert sorted(int(r.tmdb_id) for r in got.collect()) == [1, 2]   # history included


def test_daily_enrichment_on_driver_data_equals_one_shot_over_final_raw(spark):
    """Preload details/credits as of an earlier cut; two daily runs enrich the missing
    titles through the upsert paths; stored summaries and dim equal one-shot models."""
    import datetime as dt
    from samples import SF_SMALL
    from snapreel.operators import enrich as E
    from snapreel.operators.ingest import ingest_trending
    from snapreel.operators.replace import write_keyed
    from snapreel.plans import intermediate as I
    from snapreel.plans import marts as M
    from snapreel.plans import staging as S
    from snapreel.plans.catalog import Catalog
    from snapreel.sources import snapshots as SN
    shared_dir(spark)
    base = tempfile.mkdtemp(prefix="snapreel-enrich-")
    store, raw, marts = f"{base}/store", f"{base}/raw", f"{base}/marts"
    cat = Catalog(spark, SF_SMALL)
    SN.write_snapshots(cat.trending_documents(), store, "trending")
    dates = sorted(r.snapshot_date for r in SN.snapshot_inventory(spark, store, "trending").collect())
    today = (dates[-1] + dt.timedelta(days=1)).isoformat()
    ingest_trending(spark, store, f"{raw}/trending",
                    spark.createDataFrame([(d,) for d in dates[:-2]], "snapshot_date date"), today)
    cut = F.lit(dates[0].isoformat()).cast("timestamp_ntz") + F.expr("INTERVAL 10 DAYS")
    write_keyed(E.as_of(cat.raw_details, cut), f"{raw}/details")
    write_keyed(E.as_of(cat.raw_credits, cut), f"{raw}/credits")
    before = D.read_raw(spark, raw, "credits").count()
    for day in dates[-2:]:
        r = D.run_daily(spark, store, raw, marts, day.isoformat(), today=today,
                        details_landing=cat.details_documents(), credits_landing=cat.credits_documents(),
                        media_type_from="item", allow_incomplete=True)
    raw_d, raw_c = D.read_raw(spark, raw, "details"), D.read_raw(spark, raw, "credits")
    assert raw_c.count() > before                                  # titles were enriched
    want_cs = I.credits_summary_from_raw(raw_c)
    want_gs = I.genres_summary(S.stg_details_genres(raw_d))
    got_cs, got_gs = r.models["int_tmdb_credits_summary"], r.models["int_tmdb_genres_summary"]
    assert got_cs.count() == want_cs.count() and got_cs.select(want_cs.columns).exceptAll(want_cs).count() == 0
    assert got_gs.count() == want_gs.count() and got_gs.select(want_gs.columns).exceptAll(want_gs).count() == 0
    st = S.stg_trending(D.read_raw(spark, raw, "trending"), "item")
    want_dim = M.dim_content(st, S.stg_details(raw_d), want_cs, want_gs)
    got_dim = r.models["dim_content"].select(want_dim.columns)
    assert got_dim.count() == want_dim.count() and got_dim.exceptAll(want_dim).count() == 0


def _two_days(spark, base):
    item = lambda i: {"id": i, "media_type": "movie", "title": f"T{i}"}
    trending = {d: docs(spark, trending_env([item(i)], date=f"2024-03-0{d}")) for d, i in ((1, 1), (2, 2), (3, 3), (4, 4))}
    details = docs(spark, *[keyed_env(i, "movie", {"title": f"T{i}", "genres": [{"id": 1, "name": "Drama"}]}) for i in range(1, 5)])
    credits = docs(spark, *[keyed_env(i, "movie", {"crew": [{"id": 5, "name": f"D{i}", "job": "Director"}]}) for i in range(1, 5)])

    def run(day, landing=True, **kw):
        return D.run_daily(spark, f"{base}/store", f"{base}/raw", f"{base}/marts", f"2024-03-0{day}", today=f"2024-03-0{day}",
                           trending_landing=trending[day] if landing else None, details_landing=details,
                           credits_landing=credits, media_type_from="item", **kw)
    return trending, details, credits, run


def test_run_repeated_after_a_crash_between_raw_load_and_marts(spark):
    from snapreel.operators.ingest import ingest_trending
    from snapreel.sources import snapshots as SN
    shared_dir(spark)
    base = tempfile.mkdtemp(prefix="snapreel-pending-")
    trending, details, credits, run = _two_days(spark, base)
    run(1)
    day = spark.createDataFrame([(__import__("datetime").date(2024, 3, 2),)], "snapshot_date date")
    ingest_trending(spark, f"{base}/store", f"{base}/raw/trending", day, "2024-03-02", SN.with_partition(trending[2], "trending"))
    for source, landing in (("details", details), ("credits", credits)):     # raw loaded, then the job died
        D.enrich_source(spark, f"{base}/store", f"{base}/raw", source, landing, pending_root=f"{base}/marts/_pending")
    dim = {int(x.tmdb_id): x for x in run(2, landing=False).models["dim_content"].collect()}
    assert (dim[2].director_name, dim[2].genres) == ("D2", "Drama")
    assert D.pending_keys(spark, f"{base}/marts/_pending", "details") is None    # cleared with the marts


def test_gate_and_empty_fetch_raise(spark):
    import pytest
    from snapreel.operators.replay import SnapshotMissingError
    shared_dir(spark)
    base = tempfile.mkdtemp(prefix="snapreel-gate-")
    trending, _, _, run = _two_days(spark, base)
    with pytest.raises(SnapshotMissingError):
        run(1, landing=False)                                   # today's date, and nothing fetched
    with pytest.raises(D.RawIncompleteError):
        D.run_daily(spark, f"{base}/store", f"{base}/raw", f"{base}/marts", "2024-03-01", today="2024-03-01",
                    trending_landing=trending[1])               # no details, no credits


def test_late_date_reaches_the_marts(spark):
    from snapreel.operators.ingest import ingest_trending
    from snapreel.sources import snapshots as SN
    shared_dir(spark)
    base = tempfile.mkdtemp(prefix="snapreel-late-")
    trending, _, _, run = _two_days(spark, base)
    run(1)
    run(3)
    SN.write_snapshots(trending[2], f"{base}/store", "trending")
    late = spark.createDataFrame([(__import__("datetime").date(2024, 3, 2),)], "snapshot_date date")
    ingest_trending(spark, f"{base}/store", f"{base}/raw/trending", late, "2024-03-04")
    models = run(4).models
    assert models["fct_trending_daily"].count() == 4
    assert sorted(int(r.tmdb_id) for r in models["dim_content"].collect()) == [1, 2, 3, 4]


def test_pages_of_a_title_are_rows_of_their_own(spark):
    """A title is present when all its pages are; a rerun stores the missing page; fewer pages replace more."""
    from snapreel.operators import enrich as E
    from snapreel.operators import replace as RP
    from snapreel.sources import snapshots as SN
    from snapreel.sources.raw_loaders import load_credits_raw
    shared_dir(spark)
    base = tempfile.mkdtemp(prefix="snapreel-pages-")
    page = lambda p, n: {**keyed_env(7, "movie", {"cast": [{"id": p, "name": f"P{p}", "order": p}]}), "page": p, "pages": n}
    SN.write_snapshots(docs(spark, page(1, 2)), base, "credits")
    SN.write_snapshots(docs(spark, page(1, 2), page(2, 2)), base, "credits", skip_stored=True)
    assert SN.scan_snapshots(spark, base, "credits").count() == 2
    one, both = load_credits_raw(docs(spark, page(1, 2))), load_credits_raw(docs(spark, page(1, 2), page(2, 2)))
    assert E.existing_keys(one).count() == 0 and E.existing_keys(both).count() == 1
    assert RP.upsert_by_key(one, load_credits_raw(docs(spark, page(2, 2)))).count() == 2
    assert RP.upsert_by_key(both, load_credits_raw(docs(spark, page(1, 1)))).count() == 1


def test_keyed_table_layout_comes_first_and_buckets_grow(spark, monkeypatch):
    import pytest
    from snapreel.operators import replace as RP
    from snapreel.sources.raw_loaders import load_details_raw
    shared_dir(spark)
    path = tempfile.mkdtemp(prefix="snapreel-layout-") + "/details"
    rows = load_details_raw(docs(spark, *[keyed_env(i, "movie", {"title": str(i)}) for i in range(20)]))
    with pytest.raises(FileNotFoundError):
        RP.table_buckets(spark, path)
    RP.write_keyed(rows, path, buckets=2)
    RP.upsert_keyed_table(spark, path, rows)
    assert RP.read_keyed(spark, path).count() == 20
    monkeypatch.setattr(RP, "BUCKET_TARGET_BYTES", 1)
    RP.upsert_keyed_table(spark, path, rows)
    assert RP.table_buckets(spark, path) > 8
    assert RP.read_keyed(spark, path).count() == 20


def test_only_pages_of_the_latest_keys_are_counted(spark, tmp_path, monkeypatch):
    """The search for missing documents groups the loaded pages of the latest keys, not those of all history."""
    from snapreel.operators import enrich as E
    from snapreel.operators import keyindex as KI
    raw, counted, existing = str(tmp_path), [], E.existing_keys
    rows = docs(spark, *[{**keyed_env(k, "tv", {}), "page": p, "pages": 2} for k in range(1, 9) for p in (1, 2)][:-1])
    KI.load(spark, raw, "credits", D.RAW_LOADERS["credits"](rows))
    monkeypatch.setattr(E, "existing_keys", lambda df: counted.append(df.count()) or existing(df))
    latest = spark.createDataFrame([(3, "tv"), (8, "tv"), (9, "tv"), (3, "movie"), (None, "tv")], "tmdb_id int, media_type string")
    latest = latest.withColumn("tmdb_id", F.col("tmdb_id").cast("decimal(38,0)"))
    missing, _ = D.enrich_source(spark, f"{raw}/store", raw, "credits", docs(spark, keyed_env(1, "tv", {})), latest)
    assert counted == [3]
    assert {tuple(r) for r in missing.collect()} == {(8, "tv"), (9, "tv"), (3, "movie"), (None, "tv")}
