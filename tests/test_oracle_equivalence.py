"""Every registered query equals its flat DuckDB oracle on the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as ENTRY  # noqa: E402
from compare import duck, value_hash  # noqa: E402
from samples import SF_SMALL  # noqa: E402
from snapreel.plans.queries import QUERIES  # noqa: E402

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ENTRY.oracle_sql()) <= set(ENTRY.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = ENTRY.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ENTRY.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert value_hash(rows, df.columns) == value_hash(orows, ocols)


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0
    assert df.columns == ["tmdb_id", "media_type", "title", "original_title", "original_language",
                          "release_date", "runtime", "imdb_id", "director_name", "top_cast", "genres"]
