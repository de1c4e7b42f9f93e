"""Benchmark decontamination by winnowing (native).

Words are hashed; a k-gram's hash is the hash of its ``K`` word hashes. Of every
``WINDOW`` consecutive k-grams, which together span ``SPAN`` words, the smallest
hash is kept as a fingerprint, on both sides by the same rule. Two texts that
share a span of ``SPAN`` words share its k-grams and so its smallest hash:
every shared span of that length or more has a common fingerprint. Fingerprints
of documents and items are joined, each hit is extended word by word up to
``SPAN - K`` words to either side, and a hit counts when the extension reaches
``SPAN`` words. Items with fewer words are one window of their own length and
are joined by the hash of that window; at most ``SPAN - 1`` such lengths exist.

A document's words are hashed and exploded in place; only matched positions
leave that stage. The item side goes to every task when
its fingerprints are counted to be few, and is shuffled otherwise, where
adaptive execution splits a fingerprint that many documents share.

Defined cases: a null text, or one without word characters, has no words and
no hits; an item without words never occurs; repeated documents are answered
each; items of one id count once; null item ids are listed as empty strings; empty tables on either side give no hits; other columns, also
ones named like the operator's, are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapreel.llm.common import ascii_lower, counted, staged

K = 5                    # words in a k-gram
WINDOW = 6               # k-grams in a winnowing window
SPAN = K + WINDOW - 1    # words in an item window: 10
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"      # fixed value: what separates words
BROADCAST_ROWS = 1_000_000    # item fingerprints sent to every task at most (about 150 MB)


def word_hashes(text: Column) -> Column:
    """The text's words in order, each as a 64-bit hash."""
    words = F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _gram(at: Column | int, size: int) -> Column:
    """Hash of the ``size`` word hashes from position ``at``."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.xxhash64(*[F.get("h", at + i) for i in range(size)])


def _context(at: Column) -> Column:
    """The words around the k-gram at ``at``, null beyond the text's ends."""
    reach = SPAN - K
    return F.array(*[F.when(at + i >= 0, F.get("h", at + i)) for i in [*range(-reach, 0), *range(K, K + reach)]])


def _winnowed(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Explode ``h`` (word hashes) into ``keep, h, length (0), hash, at``: the smallest
    k-gram hash of each window and its first place, where it differs in value or
    place from the window before."""
    pos = F.col("pos")
    grams = F.transform("h", lambda w, i: F.xxhash64(w, *[F.get("h", i + j) for j in range(1, K)]))
    minima = F.transform("g", lambda x, i: F.least(x, *[F.get("g", i + j) for j in range(1, WINDOW)]))
    hashed = rows.select(*keep, "h", grams.alias("g")).select(*keep, "h", "g", minima.alias("m"))
    # the outer form: the inner one makes the optimizer test size(m) > 0 below, hashing all words once more
    spread = hashed.select(*keep, "h", "g", "m", F.posexplode_outer("m").alias("pos", "hash"))
    moved = (pos == 0) | (F.col("hash") != F.get("m", pos - 1)) | (F.get("g", pos - 1) == F.col("hash"))
    return spread.where((pos + SPAN <= F.size("h")) & moved).select(*keep, "h", "g", F.lit(0).alias("length"), "hash", "pos")


def _place() -> Column:
    """Where in the window at ``pos`` its smallest hash first stands."""
    window = F.slice("g", F.col("pos") + 1, F.lit(WINDOW))
    return F.col("pos") + F.array_position(window, F.col("hash")).cast("int") - 1


def _short(rows: DataFrame, lengths: list[int], keep: list[str]) -> DataFrame:
    """All word windows of the given lengths as ``keep, h, length, hash, at``."""
    spread = rows.select(*keep, "h", F.posexplode_outer("h").alias("at", "_w"))
    windows = F.array(*[F.struct(F.lit(s).alias("length"), _gram(F.col("at"), s).alias("hash")) for s in lengths])
    found = spread.select(*keep, "h", "at", F.explode(windows).alias("window"))
    return found.where(F.col("at") + F.col("window.length") <= F.size("h")).select(*keep, "h", "window.length", "window.hash", "at")


def benchmark_side(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[int], bool]:
    """Stored fingerprints of the items, the lengths of short items, and whether they are few."""
    held = staged(items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"),
                               word_hashes(F.col(text_col)).alias("h")), "decontam-items")
    short = held.where(F.size("h").between(1, SPAN - 1)).select(F.size("h").alias("n")).distinct()
    lengths = sorted(r["n"] for r in short.collect())                   # at most SPAN - 1 numbers
    prints = _winnowed(held, ["item_id"]).withColumn("at", _place())
    prints = prints.select("item_id", "length", "hash", _context(F.col("at")).alias("item_context"))
    whole = held.where(F.size("h").between(1, SPAN - 1))
    hashes = reduce(lambda rest, s: F.when(F.size("h") == s, _gram(0, s)).otherwise(rest), lengths, F.lit(None).cast("bigint"))
    whole = whole.select("item_id", F.size("h").alias("length"), hashes.alias("hash"),
                         F.lit(None).cast("array<bigint>").alias("item_context"))
    side = staged(prints.union(whole).distinct(), "decontam-prints")
    return side, lengths, side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _run(doc: str, item: str, places: list[int]) -> Column:
    """How many words agree from the k-gram outwards, in the order of ``places``."""
    run = F.lit(0)
    for p in reversed(places):
        run = F.when(F.get(doc, F.lit(p)) == F.get(item, F.lit(p)), run + 1).otherwise(F.lit(0))
    return run


def hits(docs: DataFrame, items: DataFrame, keys: list[str], item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per matched stretch: ``keys``, ``item_id``, ``first`` and ``last`` word (exclusive).

    ``docs`` holds ``keys`` and ``h``, the word hashes."""
    side, lengths, few = benchmark_side(items, item_id, item_text)
    side = F.broadcast(side) if few else side
    reach = SPAN - K
    spread = _winnowed(docs, keys)
    if not few:       # shuffled: a fingerprint takes its place and ten numbers along, never its document's hashes
        spread = spread.withColumn("at", _place()).select(*keys, "length", "hash", "at", _context(F.col("at")).alias("doc_context"))
    met = spread.join(side, ["length", "hash"])
    if few:           # in place: both are worked out for what has met only
        met = met.withColumn("at", _place()).withColumn("doc_context", _context(F.col("at")))
    met = met.select(*keys, "item_id", "length", "at", "item_context", "doc_context")
    if lengths:
        short = _short(docs, lengths, keys).join(side, ["length", "hash"])
        met = met.union(short.select(*keys, "item_id", "length", "at", "item_context", F.lit(None).cast("array<bigint>")))
    left = _run("doc_context", "item_context", list(range(reach - 1, -1, -1)))
    right = _run("doc_context", "item_context", list(range(reach, 2 * reach)))
    winnowed = F.col("length") == 0
    met = met.withColumn("left", F.when(winnowed, left).otherwise(0))
    met = met.withColumn("words", F.when(winnowed, F.col("left") + K + right).otherwise(F.col("length")))
    met = met.where(~winnowed | (F.col("words") >= SPAN))
    first = F.col("at") - F.col("left")
    return met.select(*keys, "item_id", first.alias("first"), (first + F.col("words")).alias("last")).distinct()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), word_hashes(F.col("text")).alias("h"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the documents that share a window with an item; all columns kept."""
    found = hits(_keyed(docs, id_col, text_col), items, ["doc_id", "text_key"], item_id, item_text)
    found = staged(found.select(F.col("doc_id").alias("_k_id"), F.col("text_key").alias("_k_text")).distinct(), "decontam-found")
    on = F.col(id_col).eqNullSafe(F.col("_k_id")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_k_text"))
    return docs.join(counted(found), on, "left_anti")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: ``n_words, n_hit, n_items, items_sha256, contaminated``."""
    words = _keyed(docs, id_col, text_col)
    # repeated rows (same id and text) are answered once and joined back to each
    found = hits(words, items, ["doc_id", "text_key"], item_id, item_text)
    spans = F.sort_array(F.collect_set(F.struct("first", "last")))
    covered = F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda s, x: F.struct(
        (s["n"] + F.greatest(x["last"] - F.greatest(x["first"], s["end"]), F.lit(0))).alias("n"),
        F.greatest(s["end"], x["last"]).alias("end")), lambda s: s["n"])
    ids = F.sort_array(F.collect_set("item_id"))
    per_doc = found.groupBy(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_text")).agg(
        covered.cast("bigint").alias("n_hit"), ids.alias("items"))
    sizes = words.select("doc_id", "text_key", F.size("h").cast("bigint").alias("n_words"))
    out = sizes.join(per_doc, sizes["doc_id"].eqNullSafe(per_doc["k_id"]) & (sizes["text_key"] == per_doc["k_text"]), "left")
    named = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                      F.size(named).cast("bigint").alias("n_items"),
                      F.sha2(F.concat_ws(",", named), 256).alias("items_sha256"),
                      F.col("n_hit").isNotNull().alias("contaminated"))
