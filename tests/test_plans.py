"""Physical-plan properties that matter at scale."""

import tempfile

import pytest

import __spark_entry__ as ENTRY
from snapreel.plans.queries import QUERIES
from samples import SF_SMALL
from snapreel.operators.replace import write_keyed
from snapreel.plans import intermediate as I
from snapreel.plans import marts as M
from snapreel.plans import staging as S
from snapreel.plans.catalog import Catalog
from snapreel.sources import versions as VT

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")
SIDE_EFFECT_QUERIES = {"snapshot_roundtrip", "load_once_stream", "daily_dim_content", "daily_fct_trending",
                       "daily_enriched_dim", "daily_backfill_fact", "stored_replace_after_crash", "raw_tables_by_name",
                       "copartitioned_dim", "indexed_missing_details", "indexed_missing_credits", "redelivered_stream",
                       "streamed_keyed_load", "malformed_load", "gated_daily_dim", "named_documents", "repaired_documents", "stamped_fact"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECT_QUERIES))
def test_no_python_in_registered_queries(spark, name):
    plan = _plan(ENTRY.queries()[name](spark, SF_SMALL))
    assert not any(p in plan for p in PYTHON_NODES), plan


def _stored_credits(spark):
    path = tempfile.mkdtemp(prefix="snapreel-plan-") + "/credits"
    write_keyed(Catalog(spark, SF_SMALL).raw_credits, path)
    return VT.read(spark, path).select("tmdb_id", "media_type", "payload", "load_ts")


def test_credits_summary_is_one_shuffle(spark):
    raw = _stored_credits(spark)
    cs = I.credits_summary(S.stg_credits_cast(raw), S.stg_credits_crew(raw))
    plan = _plan(cs)
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "Window" not in plan and "Join" not in plan


def test_credits_summary_from_raw_is_one_scan_one_shuffle(spark):
    plan = _plan(I.credits_summary_from_raw(_stored_credits(spark)))
    assert plan.count("FileScan parquet") == 1, plan
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_variant_path_pushed_into_scan(spark):
    raw = _stored_credits(spark)
    plan = _plan(S.stg_credits_cast(raw))
    assert "payload:struct<0:variant>" in plan.replace(" ", "")


def test_fact_has_no_shuffle(spark):
    raw = Catalog(spark, SF_SMALL).raw_trending()
    path = tempfile.mkdtemp(prefix="snapreel-plan-") + "/trending"
    raw.write.parquet(path)
    fct = M.fct_trending_daily(S.stg_trending(spark.read.parquet(path)))
    assert "Exchange" not in _plan(fct)


def test_size_check_broadcasts_small_and_not_unknown(spark):
    from pyspark.sql import functions as F
    from snapreel.operators.joins import estimated_size_bytes, is_small
    small = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    assert 0 < estimated_size_bytes(small) < 10 * 1024 * 1024 and is_small(small)
    unknown = small.select(F.explode(F.sequence(F.lit(1), F.lit(10 ** 6))))  # generator: size unknown
    assert is_small(unknown, max_bytes=1) is False


def test_staged_small_keys_are_broadcast_into_big_semi_join(spark):
    from pyspark.sql import functions as F
    from snapreel.operators.joins import restrict_to
    from snapreel.session import stage
    big = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        F.col("l_partkey").alias("tmdb_id"), F.lit("movie").alias("media_type"), "l_quantity")
    derived = big.select("tmdb_id", "media_type").where("tmdb_id < 5").distinct()
    staged = stage(derived, "test-keys")
    plan = _plan(restrict_to(big, staged, ["tmdb_id", "media_type"]))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0]


def test_missing_keys_filters_loaded_keys_before_shuffling(spark):
    from snapreel.operators import enrich as E
    from snapreel.session import stage
    c = Catalog(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="snapreel-plan-") + "/details"
    write_keyed(c.raw_details, path)
    existing = E.existing_keys(VT.read(spark, path))
    latest = stage(E.latest_trending_keys(c.raw_trending()), "test-latest")
    plan = _plan(E.missing_keys(latest, existing))
    lines = [l.strip() for l in plan.splitlines()]
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    # below the only shuffle, the loaded keys already went through the broadcast semi join
    assert any("BroadcastHashJoin" in l and "LeftSemi" in l for l in lines[exchange:]), plan


def test_details_are_broadcast_only_when_measured_small(spark):
    """The estimate of documents built from a small file says nothing of their size: under the threshold they came whole to the driver.
    Dealt out by key first, their size is measured before adaptive execution may broadcast them."""
    plan = Catalog(spark, SF_SMALL).dim_content(envelope="all", media_type_from="item")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scans = [k for k, line in enumerate(lines) if "FileScan" in line and "p_partkey" in line]
    assert len(scans) == 2                                               # details and genres
    for k in scans:
        above = [line for line in lines[:k] if "Exchange" in line]
        assert "hashpartitioning" in above[-1] and "tmdb_id" in above[-1]
