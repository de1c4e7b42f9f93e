"""Shared helpers: table reads, staged tables, ranks and running sums without a hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapreel.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Texts can be long: few of them at a time go to a Python worker or a column batch.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "256", "spark.sql.parquet.columnarReaderBatchSize": "1024"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for k, v in BATCHES.items():
        spark.conf.set(k, v)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the cluster's shared folder and read back: computed
    once, and a lost executor re-reads files instead of recomputing."""
    return stage(df, f"llm-{name}")


def dropped(table: DataFrame) -> None:
    """Delete the files of a staged table that no later step reads (what was made from it is stored)."""
    files = table.inputFiles()
    if files:
        jvm = table.sparkSession.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def settled(table: DataFrame) -> DataFrame:
    """``table``, a staged one, after the driver has let go of the plan it came from: Spark's cleaner
    removes a step's shuffle files once its plan is collected, which otherwise may take half an hour."""
    table.sparkSession.sparkContext._jvm.System.gc()
    return table


BROADCAST_ROWS = 500_000      # rows of a few numbers each that go to every task at most


def counted(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when it is counted to have ``rows`` rows or fewer of
    bounded width (a stored table: the count reads little); else as it is, to be shuffled."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def kept_by_worker(spark: SparkSession):
    """An empty dictionary of which every Python worker has one, for :func:`made_once`. Spark keeps a
    broadcast's value in a worker while its tasks use it, so caches outlive a task."""
    return spark.sparkContext.broadcast({})


def made_once(kept, name: str, make):
    """What the worker's first task made under ``name``."""
    if name not in kept.value:
        kept.value[name] = make()
    return kept.value[name]


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def rank_in_buckets(rows: DataFrame, group: list[str], bucket: str, order: list[Column],
                    out: str, total: str | None = None) -> DataFrame:
    """Add ``out``: each row's 0-based rank in its ``group`` (null is a group) by
    ``(bucket, *order)``.

    A group is ranked in pieces, one per value of ``bucket`` (which must rise
    with the order), so a group holding any share of all rows is spread over
    as many tasks as it has buckets: rows are ranked inside their piece, and
    the pieces' counts give the ranks at which they start. ``total`` adds the
    group's size. ``rows`` should be a stored table: it is read twice.
    """
    counts = rows.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
                           F.col(bucket).alias("_gb"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
                           F.sum("_n").over(whole).alias("_total"))
    piece = Window.partitionBy(*group, bucket).orderBy(*order)
    ranked = rows.withColumn("_r", F.row_number().over(piece))
    on = ranked[bucket] == starts["_gb"]
    for i, c in enumerate(group):
        on = on & ranked[c].eqNullSafe(starts[f"_g{i}"])
    out_cols = [*rows.columns]
    picked = [(F.col("_start") + F.col("_r") - 1).alias(out)]
    if total:
        picked.append(F.col("_total").alias(total))
    return ranked.join(starts, on).select(*[ranked[c] for c in out_cols], *picked)
