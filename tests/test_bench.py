"""The benchmark's models run over raw tables with the columns it selects."""

import bench
from samples import SF_SMALL
from snapreel.plans.catalog import Catalog


def test_bench_models_run(spark):
    cat = Catalog(spark, SF_SMALL)
    frames = {"trending": cat.raw_trending(), "details": cat.raw_details, "credits": cat.raw_credits}
    raw = {s: df.select(*bench.RAW_COLUMNS[s]) for s, df in frames.items()}
    models = bench.bench_models(raw)
    assert {"dim_content", "dq_not_null", "dq_unique"} <= set(models)
    for df in models.values():
        bench._noop(df)
