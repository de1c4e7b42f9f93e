"""S4 envelope stamping feeds the loaders unchanged."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from snapreel.plans import staging as S
from snapreel.sources.envelopes import stamp_keyed, stamp_trending
from snapreel.sources.raw_loaders import load_details_raw, load_trending_raw


def test_stamp_trending_with_fixed_clock(spark):
    bodies = spark.createDataFrame([('{"page": 1, "results": [{"id": 5, "title": "X"}]}',), ('{"page": 2}',)],
                                   "t string").select(F.parse_json("t").alias("body"))
    docs = stamp_trending(bodies, load_ts="2024-03-02T23:59:59.000001+00:00")
    raw = load_trending_raw(docs)
    rows = S.stg_trending(raw).collect()
    assert [(r.tmdb_id, r.title, r.trending_date, r.media_type) for r in rows] == [
        (Decimal(5), "X", dt.date(2024, 3, 2), "all")]
    assert raw.count() == 2   # the body without results still loads, and flattens to nothing


def test_stamp_keyed_uses_current_clock(spark):
    bodies = spark.createDataFrame([(7, "tv", '{"name": "Show"}')], "id long, mt string, t string") \
        .select(F.col("id").alias("tmdb_id"), F.col("mt").alias("media_type"), F.parse_json("t").alias("body"))
    raw = load_details_raw(stamp_keyed(bodies))
    r = S.stg_details(raw).collect()[0]
    assert (r.tmdb_id, r.media_type, r.title) == (Decimal(7), "tv", "Show")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((now - r.load_ts).total_seconds()) < 600
