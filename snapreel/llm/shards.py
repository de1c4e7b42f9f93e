"""Sharding by proportional stratified interleaving (native).

Rows of each source are shuffled by a seeded hash and ranked; a row's place is
its fractional rank ``(rank + 1/2) / size of its source``. Sorted by that
fraction, every stretch of the order holds the sources in their proportions,
so cutting the order into equal stretches gives shards that all match the
mixture (each source's count in a shard is within one row or so of its share)
and whose row counts differ by one at most.

Neither ranking gathers a source, or the table, in one task: both orders are
cut into even pieces (Spark's range partitions of the whole order, so that equal
shares, a large source or a row that is repeated many times are cut as well),
pieces are ranked apart and start at the running sums of the pieces' counts.

Defined cases: a null or empty source is a source of its own; a null text has
no bytes; repeated rows are kept, each with its own slot; an empty table gives
no rows; columns other than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapreel.llm.common import rank_in_buckets, staged

HASH_BITS = 60          # hex digits 1-15 of an md5
PIECE_ROWS = 1 << 20    # rows of a piece, about; a small table has a piece for each of the session's partitions
ROW_BYTES = 16          # added to a text's bytes in ``size``


def interleave(docs: DataFrame, n_shards: int = 40, seed: int = 7, id_col: str = "doc_id",
               source_col: str = "source", text_col: str = "text", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, source, ``size``, ``text_crc32``, ``shard``, ``slot``."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    crc = F.crc32(text)
    mix = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), crc.cast("string")))
    rows = staged(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"), crc.alias("text_crc32"),
        F.conv(F.substring(mix, 1, HASH_BITS // 4), 16, 10).cast("bigint").alias("mix")), "shard-rows")
    rows = rows.withColumn("copy", F.monotonically_increasing_id())          # of a stored table: parts repeated rows
    pieces = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // piece_rows))
    order = ["mix", "doc_id", "text_crc32", "copy"]

    def cut(frame, by, name):
        return staged(frame.repartitionByRange(pieces, *by).withColumn("piece", F.spark_partition_id()), name)

    ranked = rank_in_buckets(cut(rows, ["source", *order], "shard-ranks"), ["source"], "piece", [F.col(c) for c in order], "rank", total="n_source")
    share = (F.col("rank") + F.lit(0.5)) / F.col("n_source")
    by = ["share", "source", *order]
    placed = cut(ranked.drop("piece").withColumn("share", share), by, "shard-shares")
    whole = rank_in_buckets(placed, [], "piece", [F.col(c) for c in by], "place", total="n_rows")
    shard = F.expr(f"(place * {n_shards}) div n_rows")
    first = F.expr(f"(shard * n_rows + {n_shards - 1}) div {n_shards}")
    return (whole.withColumn("shard", shard).withColumn("slot", F.col("place") - first)
            .select("doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot"))
