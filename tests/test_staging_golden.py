"""Golden documents for the staging models (hand-written expectations)."""

import datetime as dt
from decimal import Decimal

import pytest

from samples import docs, keyed_env, rows, trending_env
from snapreel.plans import staging as S
from snapreel.sources.raw_loaders import load_details_raw, load_credits_raw, load_trending_raw


def _trending(spark, results, **kw):
    return S.stg_trending(load_trending_raw(docs(spark, trending_env(results, **kw))))


def test_title_falls_back_to_name(spark):
    out = _trending(spark, [
        {"id": 1, "media_type": "movie", "title": "T"},
        {"id": 2, "media_type": "tv", "name": "N"},
        {"id": 3, "media_type": "movie", "title": "T3", "name": "N3"},
    ])
    assert rows(out, "tmdb_id", "title") == [(Decimal(1), "T"), (Decimal(2), "N"), (Decimal(3), "T3")]


def test_release_date_is_strict_iso(spark):
    out = _trending(spark, [
        {"id": 1, "release_date": ""},
        {"id": 2},
        {"id": 3, "release_date": "2024-02-30"},
        {"id": 4, "release_date": "2024"},
        {"id": 5, "release_date": "2024-02-29"},
    ])
    assert rows(out, "tmdb_id", "release_date") == [
        (Decimal(1), None), (Decimal(2), None), (Decimal(3), None), (Decimal(4), None),
        (Decimal(5), dt.date(2024, 2, 29))]


def test_trending_envelope_fields_and_run_date(spark):
    raw = load_trending_raw(docs(spark, trending_env([{"id": 7, "popularity": 1.5,
                                                         "vote_count": 3, "adult": True}])),
                            snapshot_date="2024-03-05")
    r = S.stg_trending(raw).collect()[0]
    # snapshot_date is the run's argument, not the envelope's own field
    assert r.trending_date == dt.date(2024, 3, 5)
    assert r.media_type == "all" and r.time_window == "day"
    assert r.load_ts == dt.datetime(2024, 3, 1, 7, 0, 0, 123456)
    assert r.popularity == 1.5 and r.vote_count == Decimal(3) and r.is_adult is True


def test_person_items_kept_in_staging(spark):
    out = _trending(spark, [{"id": 9, "media_type": "person", "name": "P"}])
    assert rows(out, "tmdb_id", "title", "media_type") == [(Decimal(9), "P", "all")]
    item = S.stg_trending(load_trending_raw(docs(spark, trending_env(
        [{"id": 9, "media_type": "person", "name": "P"}]))), media_type_from="item")
    assert rows(item, "media_type") == [("person",)]


def test_missing_results_gives_no_rows(spark):
    env = trending_env([])
    del env["results"]
    assert _trending_raw_count(spark, env) == 0


def _trending_raw_count(spark, env):
    return S.stg_trending(load_trending_raw(docs(spark, env))).count()


def test_details_release_falls_back_to_first_air_date(spark):
    raw = load_details_raw(docs(spark,
        keyed_env(1, "tv", {"name": "Show", "release_date": "bad", "first_air_date": "2020-05-06"}),
        keyed_env(2, "movie", {"title": "Film", "release_date": "2021-01-02", "first_air_date": "2000-01-01"})))
    assert rows(S.stg_details(raw), "tmdb_id", "title", "release_date") == [
        (Decimal(1), "Show", dt.date(2020, 5, 6)), (Decimal(2), "Film", dt.date(2021, 1, 2))]


def test_numbers_round_half_away_from_zero(spark):
    raw = load_details_raw(docs(spark, keyed_env(1, "movie", {"runtime": 1.5}),
                                keyed_env(2, "movie", {"runtime": -2.5})))
    assert rows(S.stg_details(raw), "tmdb_id", "runtime") == [(Decimal(1), Decimal(2)), (Decimal(2), Decimal(-3))]


def test_non_numeric_runtime_raises(spark):
    raw = load_details_raw(docs(spark, keyed_env(1, "movie", {"runtime": "long"})))
    with pytest.raises(Exception):
        S.stg_details(raw).collect()


def test_cast_empty_null_missing_give_no_rows(spark):
    raw = load_credits_raw(docs(spark,
        keyed_env(1, "movie", {"cast": [], "crew": [{"id": 5, "name": "C", "job": "Writer"}]}),
        keyed_env(2, "movie", {"cast": None}),
        keyed_env(3, "movie", {})))
    assert S.stg_credits_cast(raw).count() == 0
    assert rows(S.stg_credits_crew(raw), "tmdb_id", "person_name", "job") == [(Decimal(1), "C", "Writer")]


def test_same_id_two_media_types_are_two_keys(spark):
    raw = load_details_raw(docs(spark, keyed_env(10, "movie", {"title": "M"}),
                                keyed_env(10, "tv", {"name": "S"})))
    assert rows(S.stg_details(raw), "tmdb_id", "media_type", "title") == [
        (Decimal(10), "movie", "M"), (Decimal(10), "tv", "S")]


def test_non_ascii_preserved(spark):
    raw = load_credits_raw(docs(spark, keyed_env(1, "movie", {
        "cast": [{"id": 1, "name": "Zoë Saldaña", "character": "Gamora", "order": 0}],
        "crew": [{"id": 2, "name": "是枝裕和", "department": "Directing", "job": "Director"}]})))
    assert rows(S.stg_credits_cast(raw), "person_name", "character_name") == [("Zoë Saldaña", "Gamora")]
    assert rows(S.stg_credits_crew(raw), "person_name") == [("是枝裕和",)]


def test_genres_flatten(spark):
    raw = load_details_raw(docs(spark, keyed_env(1, "movie", {
        "genres": [{"id": 18, "name": "Drama"}, {"id": 35, "name": "Comedy"}]})))
    assert rows(S.stg_details_genres(raw), "genre_id", "genre_name") == [
        (Decimal(18), "Drama"), (Decimal(35), "Comedy")]
