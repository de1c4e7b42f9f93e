"""Documents are built once, however many steps of a query read them."""

from pyspark.sql import functions as F

from samples import SF_SMALL
from snapreel.operators import enrich as E
from snapreel.operators import keyindex as KI
from snapreel.plans import intermediate as I
from snapreel.plans import queries
from snapreel.plans import staging as S
from snapreel.plans.catalog import Catalog
from snapreel.session import scratch_path
from snapreel.sources import versions as VT


def _builds(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("to_variant_object")


def test_filters_on_fields_do_not_build_the_document_again(spark):
    c = Catalog(spark, SF_SMALL)
    cut = F.lit("2024-02-01").cast("timestamp_ntz")
    for raw in (c.raw_details, c.raw_credits):
        rows = E.as_of(raw, cut).where(F.col("tmdb_id").isNotNull() & (F.col("media_type") == "movie"))
        assert _builds(rows) == 1
    assert _builds(E.latest_snapshot(c.raw_trending())) == 1


def test_kept_documents_and_rows_are_written_once(spark):
    plain, documents, raw = (Catalog(spark, SF_SMALL, keep=k) for k in (None, "documents", "raw"))
    texts = lambda df: sorted(r[0] for r in df.select(F.to_json("doc")).collect())
    assert texts(documents.details_documents()) == texts(plain.details_documents())
    assert documents.credits_documents() is documents.credits_documents() and raw.raw_trending() is raw.raw_trending()
    assert [_builds(df) for df in (documents.credits_documents(), documents.raw_credits, raw.raw_credits, raw.raw_trending())] == [0] * 4
    keys = lambda c: sorted(map(tuple, c.raw_credits.select("tmdb_id", "media_type", "load_ts", "page", "pages").collect()))
    assert keys(raw) == keys(plain)


def test_a_load_computes_its_rows_once(spark):
    root, calls = scratch_path(spark, "once"), spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(n):
        calls.add(1)
        return n

    for load in (1, 2):
        rows = spark.range(40 * load).select(counted("id").cast("decimal(38,0)").alias("tmdb_id"), F.lit("movie").alias("media_type"),
                                             F.parse_json(F.lit("{}")).alias("payload"), F.lit("2024-01-01").cast("timestamp_ntz").alias("load_ts"))
        before = calls.value
        KI.load(spark, root, "details", rows)
        assert calls.value - before == 40 * load
        held = [sorted(int(r[0]) for r in df.select("tmdb_id").collect()) for df in (VT.read(spark, f"{root}/details"), KI.loaded_keys(spark, root, "details"))]
        assert held[0] == held[1] == list(range(40 * load))


def test_split_summary_builds_its_people_once(spark):
    raw = Catalog(spark, SF_SMALL).raw_credits
    split = I.credits_summary_split(raw, 4)
    assert _builds(split) == 0                                             # read back, not built for each of its uses
    assert sorted(map(str, split.collect())) == sorted(map(str, I.credits_summary_from_raw(raw).collect()))


def test_checks_and_missing_keys_build_documents_once(spark):
    assert _builds(queries.dq_all(spark, SF_SMALL)) == 0
    assert _builds(queries.missing_keys_credits(spark, SF_SMALL)) <= 2     # the credits, semi join side included; no trending


def test_summary_reads_only_the_people_it_needs(spark):
    payloads = ['{"cast": [{"name": "B", "order": 0}, {"name": "X", "order": 9}, {"name": "A", "order": 2}], "crew": [{"name": "D", "job": "Director"}, {"name": "W", "job": "Writer"}]}',
                '{"cast": [], "crew": [{"name": "W", "job": "Writer"}, {"name": "V", "job": "Writer"}]}', '{"crew": [{"name": "D", "job": null}]}',
                '{"cast": [null, {"name": "Y", "order": 7}], "crew": [{"name": "W", "job": "Writer"}]}', '{"cast": {"a": {"name": "C", "order": 1}}}',
                '{"cast": [], "crew": []}', '{}', '{"cast": null, "crew": null}']
    rows = spark.createDataFrame([(k, p) for k, p in enumerate(payloads)], "k int, p string").select(
        F.col("k").cast("decimal(38,0)").alias("tmdb_id"), F.lit("movie").alias("media_type"), F.parse_json("p").alias("payload"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("load_ts"))
    whole = I.credits_summary(S.stg_credits_cast(rows), S.stg_credits_crew(rows))
    texts = lambda df: sorted(map(str, df.collect()))
    assert texts(I.credits_summary_from_raw(rows)) == texts(whole) == texts(I.credits_summary_split(rows, 3))
    assert whole.count() == 5
    names = sorted(str(r[0]) for r in I.people_from_raw(rows).select("person_name").collect())
    assert "X" not in names and "V" not in names and {"A", "B", "C", "D", "W"} <= set(names)


def test_raw_documents_are_stored_whole(spark):
    path = scratch_path(spark, "whole-documents")
    rows = Catalog(spark, SF_SMALL).raw_trending()
    VT.publish(rows, path, ["snapshot_date"])
    found = VT.read(spark, path)
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(found.inputFiles()[0]), spark.sparkContext._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    layout = reader.getFooter().getFileMetaData().getSchema().toString()
    reader.close()
    assert "payload" in layout and "typed_value" not in layout
    texts = lambda df: sorted(r[0] for r in df.select(F.to_json("payload")).collect())
    assert texts(found) == texts(rows)
