"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. Adaptive execution re-plans joins from
# runtime sizes (broadcast only when a side is measured small), coalesces
# small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # The vectorized Parquet reader buffers a whole batch of rows per column:
    # for raw tables that is batch rows x document size. 128 rows keep a
    # batch of the largest pages (~3 MB) near 400 MB per task.
    "spark.sql.parquet.columnarReaderBatchSize": "128",
    # Documents are stored and read whole: guessing a shredded layout for each file and
    # putting the documents together again took most of a raw table's write and read.
    "spark.sql.variant.inferShreddingSchema": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MIB = 1024 * 1024


def scale_conf(largest_shuffle_bytes: int, total_cores: int,
               partition_bytes: int = 256 * MIB) -> dict[str, str]:
    """Settings sized for a cluster run.

    ``largest_shuffle_bytes`` is the biggest exchange expected (after
    projection and partial aggregation -- for these jobs the trending
    distinct and the keyed aggregations, far below the raw input). The
    initial shuffle width gives ~``partition_bytes`` per task; adaptive
    execution then coalesces small partitions toward the advisory size and
    splits skewed ones, so over-estimating is cheap and under-estimating
    only costs spill. Scans split files at 512 MiB, so a 100 TB scan is
    ~200k tasks over 1000 executors.
    """
    width = max(2 * total_cores, -(-largest_shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(partition_bytes // 4),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MIB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MIB),
    }


def build_session(master: str | None = None, app_name: str = "snapreel",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`DEFAULT_CONF` applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in DEFAULT_CONF.items():
        if not k.startswith("spark.ui."):
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for materialised intermediates.

    Read from ``spark.checkpoint.dir``. Only when the session has none (local
    tests) a fresh temporary folder is created and registered, so that
    ``DataFrame.checkpoint()`` and written intermediate tables have a home.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        # set earlier in this process; the registered dir has a uuid child
        return current.rsplit("/", 1)[0]
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share: "
                         "a temporary folder would be another one on each machine")
    local = tempfile.mkdtemp(prefix="snapreel-shared-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df, name: str = "stage"):
    """Write ``df`` as Parquet under :func:`shared_dir` and return it read back.

    Used for the small per-run sets (missing keys, a day's new rows, touched
    titles): it cuts their lineage (a lost executor re-reads the files
    instead of recomputing), they are computed once instead of once per use,
    and the optimizer then knows their real size, so the size-checked
    broadcast of a small side into a big table's semi join can fire at
    planning time -- before the big side would be shuffled.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
