"""Token-id files: documents' ids in ascending id order, range coded in blocks.

A token file is a Parquet folder with one row per block: ``part`` and ``block``
(the order of blocks), the ids and lengths of the documents the block holds,
and ``body``, a self-contained block of :mod:`snapreel.llm.rangecoder`. Blocks
hold whole documents and about ``block_ids`` ids, or one longer document; any
block can be decoded alone, and a damaged one fails its checksums.

Writing range-partitions the documents by id (equal and null ids are spread by
a hash of their text), sorts each part and encodes it in one pass over its
rows. Where a document's ids start among all ids follows from the blocks'
sizes alone, summed part by part, so nothing is counted in one task but one
number per part.

Defined cases: a null or empty text has the end id only; null ids come first;
rows with equal ids are ordered by their text's hash; an empty table gives an
empty file; a text of any length is one document; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapreel.llm import rangecoder
from snapreel.llm.common import kept_by_worker, made_once
from snapreel.llm.tokens import IdEncoder

BLOCK_IDS = 1 << 22
VOCABULARY = 50257
BLOCKS = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_tokens", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("body", pa.binary())])
BLOCK_DDL = "part int, block int, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, body binary"


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, vocabulary: int = VOCABULARY,
              block_ids: int = BLOCK_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, write blocks in ascending id order."""
    kept = kept_by_worker(docs.sparkSession)

    def blocks(batches):
        encoder, part, number = made_once(kept, "encoder", lambda: IdEncoder(tokenizer)), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        names, held, size = [], [], 0

        def block():
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            row = [part, number, len(ids), names, [len(h) // 4 for h in held], rangecoder.encode(ids, vocabulary)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCKS)], schema=BLOCKS)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py()) + end
                names.append(doc_id)
                held.append(ids)
                size += len(ids) // 4
                if size >= block_ids:
                    yield block()
                    names, held, size, number = [], [], 0, number + 1
        if held:
            yield block()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("mix", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "mix").sortWithinPartitions("doc_id", "mix").select("doc_id", "text")
    ordered.mapInArrow(blocks, BLOCK_DDL).write.mode("overwrite").parquet(path)


def block_starts(blocks: DataFrame) -> DataFrame:
    """``part, block, first``: the ids of all blocks before each."""
    sizes = blocks.select("part", "block", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row per writing task
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_first"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return inside.join(parts, "part").select("part", "block", (F.col("part_first") + F.col("inside")).alias("first"))


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of a token file: ``doc_id, start, n_tokens, ids_crc32``
    and, with ``with_ids``, ``ids`` themselves (end id included)."""
    blocks = spark.read.schema(BLOCK_DDL).parquet(path)
    ddl = "part int, block int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    ddl += ", ids array<bigint>" if with_ids else ""

    def documents(batches):
        for batch in batches:
            for part, block, _, names, lengths, body in zip(*(c.to_pylist() for c in batch.columns)):
                ids = rangecoder.decode(body)
                ends = np.cumsum(lengths)
                if len(ids) != (ends[-1] if len(ends) else 0):
                    raise ValueError(f"block {part}/{block} does not hold its documents' ids")
                own = [ids[b - n:b] for b, n in zip(ends, lengths)]
                columns = [pa.array([part] * len(own), pa.int32()), pa.array([block] * len(own), pa.int32()),
                           pa.array(names, pa.int64()), pa.array(ends - np.array(lengths), pa.int64()),
                           pa.array(lengths, pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64())]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ddl.split(", ")])

    found = blocks.mapInArrow(documents, ddl)
    out = ["doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"]
    return found.join(block_starts(blocks), ["part", "block"]).select(*out, *(["ids"] if with_ids else []))
