"""Ranked lexical search, reversed: documents stream through an index of the queries.

The side that is searched for is the small one, so it is the one indexed: an
inverted index over the items' terms (term -> items and how often each repeats
it) goes to every task. Three steps, none of which gathers documents:

1. *Counts.* Every document is cut into terms once; what is kept of it is its
   number of terms and the counts of the terms that some item has.
2. *Statistics* over all documents: how many have terms, their length, and for
   each of the items' terms how many documents hold it.
3. *Scores.* Each task streams the kept counts through the index, adds up the
   scores of the items a document meets, and offers them to one bounded heap per
   item. The tasks' heaps (``k`` rows an item and task) are merged.

Items are taken in blocks of bounded size (``BLOCK_ITEMS``, ``BLOCK_BYTES``, checked;
one longer item is a block): more items mean more passes, never a larger index.

A term's weight is ``floor(1000 ln((2N + 2) / (2 df + 1)))``; all else is 64-bit
integer arithmetic, so scores do not depend on the order of work.

Defined cases: a null or empty text has no terms and is not found; an item
without terms finds nothing; an item given twice with the same text is one
item, with another text it is an item of its own under the same id; every row
of a repeated document is ranked; equal scores are ordered by ascending id,
null ids last; an empty table on either side gives no rows; texts are taken
whole; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapreel.llm.common import staged

BLOCK_ITEMS = 4096
BLOCK_BYTES = 8 << 20          # text of the items of one block
STEP = 1 << 20                 # postings met at a time in a task
# letters and digits of ASCII (lower-cased) and every byte beyond it stand in terms, the rest parts them
FOLD = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class ItemIndex:
    """Inverted index of one block of items."""

    def __init__(self, texts: list[bytes]):
        self.vocabulary: dict[bytes, int] = {}
        postings: list[list[tuple[int, int]]] = []
        for item, text in enumerate(texts):
            for term, times in Counter(terms_of(text)).items():
                if term not in self.vocabulary:
                    self.vocabulary[term] = len(postings)
                    postings.append([])
                postings[self.vocabulary[term]].append((item, times))
        flat = np.array([p for term in postings for p in term], np.int64).reshape(-1, 2)
        self.first = np.cumsum([0] + [len(p) for p in postings])
        self.item, self.times, self.n_items = flat[:, 0], flat[:, 1], len(texts)


def term_counts(docs: DataFrame, index: ItemIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_terms, term, times``: a document's length and its counts of the index's terms (arrays)."""
    known = docs.sparkSession.sparkContext.broadcast(index.vocabulary)

    def count(batches):
        vocabulary = known.value
        for batch in batches:
            sizes, term, times, ends = [], [], [], [0]
            for text in batch.column(1):
                words = terms_of(text.as_py() or b"")
                met = Counter(filter(vocabulary.__contains__, words))
                sizes.append(len(words))
                term += map(vocabulary.__getitem__, met)
                times += met.values()
                ends.append(len(term))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))], ["doc_id", "n_terms", "term", "times"])
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(count, "doc_id bigint, n_terms bigint, term array<int>, times array<int>")


class Heaps:
    """The best ``k`` documents of each item seen so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n_items)]
        self.floor = np.ones(n_items, np.int64)        # a lower score cannot enter

    def offer(self, item: np.ndarray, score: np.ndarray, ids: list) -> None:
        for i, s, doc in zip(item.tolist(), score.tolist(), ids):
            heap, entry = self.heaps[i], (s, doc is not None, -doc if doc is not None else 0)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.floor[i] = heap[0][0]

    def rows(self) -> list[tuple]:
        return [(i, -d if known else None, s) for i, heap in enumerate(self.heaps) for s, known, d in heap]


def best(counts: DataFrame, index: ItemIndex, weights: list[int], n_docs: int, length: int, k: int) -> DataFrame:
    """``item, doc_id, score``: every task's heaps."""
    shared = counts.sparkSession.sparkContext.broadcast(
        (index.first, index.item, index.times * np.array(weights, np.int64)[np.repeat(np.arange(len(weights)), np.diff(index.first))],
         index.n_items))

    def score(batches):
        first, posted, weight, n_items = shared.value
        heaps = Heaps(n_items, k)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            m = np.array([100 - 75 + (75 * n * n_docs) // length for n in batch.column(1).to_pylist()], np.int64)
            size = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            term, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
            doc = np.repeat(np.arange(len(ids)), size)
            part = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
            met = first[term + 1] - first[term]
            ends = np.concatenate([[0], np.cumsum(met)])
            at_doc = ends[np.concatenate([[0], np.cumsum(size)])]        # postings met before each document
            low = 0
            while low < len(ids):                                        # documents that meet STEP postings, or one
                high = min(int(np.searchsorted(at_doc, at_doc[low] + STEP, side="right")) - 1, low + max(1, STEP // n_items))
                high = max(low + 1, high)
                a, b = np.searchsorted(doc, [low, high])
                entry = np.repeat(np.arange(a, b), met[a:b])
                place = first[term[entry]] + np.arange(ends[a], ends[b]) - ends[entry]
                sums = np.zeros((high - low) * n_items, np.int64)
                np.add.at(sums, (doc[entry] - low) * n_items + posted[place], weight[place] * part[entry])
                sums = sums.reshape(high - low, n_items)
                row, item = np.nonzero(sums >= heaps.floor)
                heaps.offer(item, sums[row, item], [ids[low + r] for r in row.tolist()])
                low = high
        found = heaps.rows()
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
                                         ["item", "doc_id", "score"])
    return counts.select("doc_id", "n_terms", "term", "times").mapInArrow(score, "item int, doc_id bigint, score bigint")


def blocks_of(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The distinct items with the ``block`` they are in, and the number of blocks."""
    rows = staged(items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).cast("binary").alias("text"))
                  .where(F.octet_length(text_col) > 0).distinct(), "search-items")
    blocks = 1
    while True:
        cut = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
        sizes = cut.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
        over = sizes.where((F.col("n") > 1) & ((F.col("n") > BLOCK_ITEMS) | (F.col("bytes") > BLOCK_BYTES)))
        if over.first() is None:
            return cut, blocks
        blocks *= 2


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Each item's ``k`` best documents: ``item_id, rank, doc_id, score`` (score above 0)."""
    spark = docs.sparkSession
    cut, blocks = blocks_of(items, item_col, item_text_col)
    found = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for block in range(blocks):
        held = cut.where(F.col("block") == block).select("item_id", "text").collect()      # bounded by blocks_of
        index = ItemIndex([bytes(r["text"]) for r in held])
        if not index.vocabulary:
            continue
        counts = staged(term_counts(docs, index, id_col, text_col), "search-counts")
        total = counts.agg(F.count_if(F.col("n_terms") > 0).alias("n"), F.sum("n_terms").alias("l")).first()
        if not total["n"]:
            continue
        df = {r["t"]: r["count"] for r in counts.select(F.explode("term").alias("t")).groupBy("t").count().collect()}
        weights = [math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(index.vocabulary))]
        heaps = best(counts, index, weights, total["n"], total["l"], k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        merged = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(n, r["item_id"]) for n, r in enumerate(held)], "item int, item_id bigint")
        found = found.union(merged.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return found
