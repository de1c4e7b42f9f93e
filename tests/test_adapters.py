"""Adapter invariants: bounded pages, every input row in exactly one document."""

from pyspark.sql import functions as F

from samples import SF_SMALL
from snapreel.sources import adapters as A


def test_trending_pages_are_bounded_and_complete(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    docs = A.trending_documents(ev, page_ids=16)
    sizes = docs.select(F.expr("array_size(variant_get(doc, '$.results', 'array<variant>'))").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 16
    assert sizes.agg(F.sum("n")).first()[0] == ev.count()


def test_credits_pages_cover_every_line_once(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    sup = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    docs = A.credits_documents(li, sup, page_orders=32)
    n = docs.select(F.expr("array_size(variant_get(doc, '$.data.cast', 'array<variant>'))").alias("n"),
                    F.expr("array_size(variant_get(doc, '$.data.crew', 'array<variant>'))").alias("m"))
    joined = li.join(sup.select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey").count()
    totals = n.agg(F.sum("n"), F.sum("m")).first()
    assert totals[0] == totals[1] == joined


def test_details_one_document_per_part(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    docs = A.details_documents(part)
    assert docs.count() == part.count()
    keys = docs.select(F.expr("variant_get(doc, '$.tmdb_id', 'bigint')").alias("k")).distinct().count()
    assert keys == part.count()
