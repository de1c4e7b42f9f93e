"""Small documents and helpers shared by the core tests (a module of its own name:
``tests/llm`` has a ``conftest`` too)."""

import json

from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"


def docs(spark, *envelopes):
    """DataFrame with one VARIANT ``doc`` per envelope (dict or raw JSON text)."""
    rows = [(e if isinstance(e, str) else json.dumps(e, ensure_ascii=False),) for e in envelopes]
    return spark.createDataFrame(rows, "text string").select(F.parse_json("text").alias("doc"))


def trending_env(results, date="2024-03-01", media_type="all", window="day",
                 load_ts="2024-03-01T07:00:00.123456+00:00"):
    return {"media_type": media_type, "time_window": window, "snapshot_date": date,
            "load_ts": load_ts, "results": results}


def keyed_env(tmdb_id, media_type, data, load_ts="2024-03-01T08:00:00+00:00"):
    return {"media_type": media_type, "tmdb_id": tmdb_id, "load_ts": load_ts, "data": data}


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
