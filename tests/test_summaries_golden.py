"""Golden documents for the credits/genres summaries and dim_content."""

from decimal import Decimal

from samples import docs, keyed_env, rows, trending_env
from snapreel.operators import quality as Q
from snapreel.plans import intermediate as I
from snapreel.plans import marts as M
from snapreel.plans import staging as S
from snapreel.sources.raw_loaders import load_credits_raw, load_details_raw, load_trending_raw


def _summary(spark, *envs):
    raw = load_credits_raw(docs(spark, *envs))
    return I.credits_summary(S.stg_credits_cast(raw), S.stg_credits_crew(raw))


def test_no_director_keeps_row_with_nulls(spark):
    out = _summary(spark, keyed_env(1, "movie", {"crew": [{"id": 1, "name": "W", "job": "Writer"}]}))
    r = out.collect()
    assert len(r) == 1 and r[0].director_name is None and r[0].load_ts is None and r[0].top_cast is None


def test_first_director_skips_null_name(spark):
    out = _summary(spark, keyed_env(1, "movie", {"crew": [
        {"id": 1, "name": None, "job": "Director"},
        {"id": 2, "name": "Zed", "job": "Director"},
        {"id": 3, "name": "Amy", "job": "Director"},
        {"id": 4, "name": "Aaron", "job": "director"}]}))  # case-sensitive job
    r = out.collect()[0]
    assert r.director_name == "Amy" and r.load_ts is not None


def test_top_cast_orders_and_ties(spark):
    out = _summary(spark, keyed_env(1, "movie", {"cast": [
        {"id": 1, "name": "Bea", "order": 0}, {"id": 2, "name": "Al", "order": 0},
        {"id": 3, "name": "Cy", "order": 1}, {"id": 4, "name": "Di", "order": 2},
        {"id": 5, "name": "Ed", "order": 3}, {"id": 6, "name": "Fo"}]}))
    assert out.collect()[0].top_cast == "Al, Bea, Cy, Di"


def test_top_cast_all_null_names_is_empty_string(spark):
    out = _summary(spark,
                   keyed_env(1, "movie", {"cast": [{"id": 1, "name": None, "order": 0}]}),
                   keyed_env(2, "movie", {"cast": [{"id": 1, "name": "X", "order": 5}]}))
    assert rows(out, "tmdb_id", "top_cast") == [(Decimal(1), ""), (Decimal(2), None)]


def test_credits_keys_union_of_cast_and_crew(spark):
    out = _summary(spark,
                   keyed_env(1, "movie", {"cast": [{"id": 1, "name": "A", "order": 0}]}),
                   keyed_env(2, "tv", {"crew": [{"id": 1, "name": "B", "job": "Director"}]}),
                   keyed_env(3, "movie", {"cast": [], "crew": []}))
    assert rows(out, "tmdb_id", "media_type") == [(Decimal(1), "movie"), (Decimal(2), "tv")]


def test_duplicate_genre_listed_twice(spark):
    raw = load_details_raw(docs(spark, keyed_env(1, "movie", {"genres": [
        {"id": 1, "name": "Drama"}, {"id": 2, "name": "Drama"}, {"id": 3, "name": "Action"}]})))
    out = I.genres_summary(S.stg_details_genres(raw))
    assert out.collect()[0].genres == "Action, Drama, Drama"


def _dim(spark, trending_envs, media_type_from="envelope"):
    t = S.stg_trending(load_trending_raw(docs(spark, *trending_envs)), media_type_from)
    d_raw = load_details_raw(docs(spark, keyed_env(7, "movie", {"title": "Details Title",
                                                                "runtime": 100, "genres": [{"id": 1, "name": "Drama"}]})))
    c_raw = load_credits_raw(docs(spark, keyed_env(7, "movie", {
        "cast": [{"id": 1, "name": "Ann", "order": 0}],
        "crew": [{"id": 2, "name": "Dan", "job": "Director"}]})))
    cs = I.credits_summary(S.stg_credits_cast(c_raw), S.stg_credits_crew(c_raw))
    gs = I.genres_summary(S.stg_details_genres(d_raw))
    return M.dim_content(t, S.stg_details(d_raw), cs, gs)


def test_dim_literal_all_envelope_is_not_enriched(spark):
    out = _dim(spark, [trending_env([{"id": 7, "media_type": "movie", "title": "T"}])])
    r = out.collect()
    assert len(r) == 1 and r[0].media_type == "all" and r[0].runtime is None and r[0].director_name is None


def test_dim_item_mode_is_enriched(spark):
    out = _dim(spark, [trending_env([{"id": 7, "media_type": "movie", "title": "T"},
                                     {"id": 8, "media_type": "person", "name": "P"}])], "item")
    got = {r.tmdb_id: r for r in out.collect()}
    r = got[Decimal(7)]
    assert (r.title, r.runtime, r.director_name, r.top_cast, r.genres) == (
        "Details Title", Decimal(100), "Dan", "Ann", "Drama")
    assert got[Decimal(8)].media_type == "person"  # people stay in the dimension


def test_title_change_gives_two_rows_and_one_duplicate_key(spark):
    out = _dim(spark, [trending_env([{"id": 9, "media_type": "tv", "name": "Old"}], date="2024-03-01"),
                       trending_env([{"id": 9, "media_type": "tv", "name": "New"}], date="2024-03-02")],
               "item")
    assert out.count() == 2
    res = Q.unique_combination(out, ["tmdb_id", "media_type"], "dim_content").collect()[0]
    assert res.failing_groups == 1 and res.failing_rows == 2


def test_null_key_is_kept_without_enrichment(spark):
    out = _summary(spark, keyed_env(None, "movie", {
        "cast": [{"id": 1, "name": "A", "order": 0}],
        "crew": [{"id": 2, "name": "B", "job": "Director"}]}))
    r = out.collect()
    assert len(r) == 1 and r[0].tmdb_id is None
    assert (r[0].director_name, r[0].top_cast, r[0].load_ts) == (None, None, None)


def test_single_scan_summary_equals_two_scan_form(spark):
    from samples import SF_SMALL
    from snapreel.plans.catalog import Catalog
    raw = load_credits_raw(docs(spark,
        keyed_env(1, "movie", {"cast": [{"id": 1, "name": "A", "order": 0}, {"id": 2, "name": None, "order": 1}],
                               "crew": [{"id": 3, "name": "D", "job": "Director"}]}),
        keyed_env(2, "tv", {"cast": None, "crew": {"k": {"id": 4, "name": "O", "job": "Director"}}}),
        keyed_env(3, "movie", {})))
    for r in (raw, Catalog(spark, SF_SMALL).raw_credits):
        a = I.credits_summary(S.stg_credits_cast(r), S.stg_credits_crew(r))
        b = I.credits_summary_from_raw(r)
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_names_of_a_hot_title_are_aggregated_in_ranges(spark, monkeypatch):
    """A third of all rows on one title: spread over tasks, and the same strings; NULL names and orders included."""
    from pyspark.sql import functions as F
    from snapreel.functions import aggregates as A
    rows = [(1, "m", None if k % 50 == 0 else f"N{k % 700:03d}", None if k % 31 == 0 else k % 3) for k in range(3000)]
    rows += [(k, "m", f"P{k % 7}" if k % 5 else None, k % 3) for k in range(2, 5000)] + [(0, "m", None, 1), (None, "m", "X", 0)]
    people = spark.createDataFrame(rows, "tmdb_id int, media_type string, person_name string, cast_order int")
    key, order = ["tmdb_id", "media_type"], ["cast_order", "person_name"]
    want = people.groupBy(*key).agg(A.ordered_listagg("person_name", order).alias("s"))
    got = A.split_listagg(people, key, "person_name", order, "s", pieces=16)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    dealt = people.repartitionByRange(16, *key, *[F.asc_nulls_last(c) for c in order]).withColumn("p", F.spark_partition_id())
    assert dealt.where("tmdb_id = 1").select("p").distinct().count() >= 4


def test_summary_of_titles_of_many_pages(spark, monkeypatch):
    from snapreel.plans import intermediate as I
    from snapreel.sources.raw_loaders import load_credits_raw
    page = lambda t, p, of: {**keyed_env(t, "tv", {"cast": [{"id": p, "name": f"N{9 - p}", "order": p % 4}, {"id": 50, "name": None, "order": 0}],
                                                   "crew": [{"id": 1, "name": f"D{p}", "job": "Director"}]}), "page": p, "pages": of}
    raw = load_credits_raw(docs(spark, *[page(1, p, 6) for p in range(1, 7)], page(2, 1, 1), keyed_env(3, "tv", {"crew": [{"id": 1, "name": "W", "job": "Writer"}]})))
    monkeypatch.setattr(I, "HOT_PAGES", 2)
    got, want = I.credits_summary_of_any(raw), I.credits_summary_from_raw(raw)
    assert got.count() == want.count() == 3 and got.select(want.columns).exceptAll(want).count() == 0
    split = I.credits_summary_split(raw, 4)
    assert split.count() == 3 and split.select(want.columns).exceptAll(want).count() == 0


def test_many_pages_of_few_people_are_not_a_hot_title(spark, monkeypatch):
    from snapreel.plans import intermediate as I
    page = lambda t, p, of, n: {**keyed_env(t, "tv", {"cast": [{"id": k, "name": f"N{p}{k}", "order": k % 3} for k in range(n)],
                                                      "crew": [{"id": 1, "name": f"D{p}", "job": "Director"}]}), "page": p, "pages": of}
    raw = load_credits_raw(docs(spark, *[page(1, p, 4, 1) for p in range(1, 5)], *[page(2, p, 4, 9) for p in range(1, 5)], *[page(None, p, 4, 9) for p in range(1, 5)]))
    want = I.credits_summary_from_raw(raw)
    ranged, split = [], I._split_people
    monkeypatch.setattr(I, "HOT_PAGES", 2)
    monkeypatch.setattr(I, "_split_people", lambda people, n: ranged.append(people) or split(people, n))
    for most, titles in ((100, None), (20, {2, None})):                   # nothing is hot; the titles of 40 people are
        monkeypatch.setattr(I, "HOT_PEOPLE", most)
        got = I.credits_summary_of_any(raw)
        assert got.count() == want.count() == 3 and got.select(want.columns).exceptAll(want).count() == 0
        assert (ranged == []) if titles is None else ({r[0] for r in ranged[0].select("tmdb_id").collect()} == titles)
