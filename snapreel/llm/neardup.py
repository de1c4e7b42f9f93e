"""Near-duplicate documents: MinHash signatures joined by their coordinates.

1. A text's set is its distinct word shingles, as 64-bit hashes; rows of equal
   sets form one class, and only classes are compared.
2. A class's signature has ``coordinates`` minima. It is posted under every
   (coordinate, value) pair; a posting that no other class shares is dropped.
   Two sets as similar as ``similarity`` agree in fewer than ``matches``
   coordinates with a chance near 1e-6 at the default values, so a class with
   fewer shared postings than ``matches`` is done.
3. Prefix: two classes that agree in ``matches`` postings share one among the
   first ``shared - matches + 1`` of each, in one order of all postings, rarest
   first. Only those lists are merged; the other postings are skipped over and
   counted from the signatures that the list's members bring along.
4. Lists are merged in two rounds: first the longest prefix list of each class
   alone, then all prefix lists that still hold more than one component. A list
   is cut into chunks; each pair of chunks is one bounded piece of work, which
   counts matches, confirms pairs above the threshold on full sets and gives
   back a spanning forest of the links between components, never the pairs.
5. Components of the links; the smallest document id names each.

Defined cases: a null text, or one without words, has an empty set, is linked
with nothing and is its own component; fewer words than a shingle make one
shingle of all of them; repeated rows share a class; rows without an id count
after all ids; an empty table gives no rows; texts of any length are whole;
other columns are ignored (:func:`deduplicate` keeps them).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapreel.llm.common import counted, dropped, settled, staged
from snapreel.llm.components import components

COORDINATES, MATCHES = 48, 24
CHUNK_ROWS, CHUNK_SHINGLES = 384, 400_000     # aimed-at size of half a piece of work
ODD = 0x9E3779B97F4A7C15
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class Shingler:
    """``sets(text)``: sorted distinct 64-bit hashes of the text's word shingles."""

    def __init__(self, words: int, cache_size: int = 400_000):
        import xxhash
        self.words, self.cache_size, self.cache = words, cache_size, {}
        self.digest = xxhash.xxh3_64_digest
        self.weights = [pow(ODD, k + 1, 1 << 64) for k in range(words)]

    def set(self, text: str | None) -> np.ndarray:
        split = (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()
        if not split:
            return np.zeros(0, dtype=np.uint64)
        found = list(map(self.cache.get, split))
        if None in found:
            new = {w: self.digest(w) for w, h in zip(split, found) if h is None}
            if len(self.cache) + len(new) > self.cache_size:
                self.cache.clear()
            found = [h if h is not None else new[w] for w, h in zip(split, found)]
            self.cache.update(new)
        h = np.frombuffer(b"".join(found), dtype="<u8")
        n = min(self.words, len(h))
        total = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            total += h[k:len(h) - n + 1 + k] * np.uint64(self.weights[k])
        total ^= total >> np.uint64(29)
        total *= np.uint64(ODD)
        return np.unique(total ^ (total >> np.uint64(32)))


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Minima of ``coordinates`` seeded hashes of the set, as signed 64-bit numbers.

    Minima lie close to zero: of 32 bits, those of a thousand shingles would have four million
    values, and sets that share nothing would meet by chance, in numbers that grow with their square."""
    rng = np.random.default_rng(11)
    a = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64)
    best = np.full(coordinates, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        x = shingles[at:at + 4096]
        for i in range(coordinates):
            best[i] = min(best[i], (x * a[i] + b[i]).min())
    return best.view(np.int64)


def signatures(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    """``doc_id, mark`` (a hash of the text), ``key`` of the set (null when empty), size, signature."""
    def sign(batches):
        shingler = Shingler(words)
        for batch in batches:
            keys, sizes, signs = [], [], []
            for text in batch.column(2):
                s = shingler.set(text.as_py())
                sizes.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                signs.append(signature(s, coordinates) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(signs, pa.list_(pa.int64()))], ["doc_id", "mark", "key", "n_shingles", "signature"])
    return docs.mapInArrow(sign, "doc_id bigint, mark bigint, key binary, n_shingles bigint, signature array<bigint>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """``key, shingles`` of each row with a set."""
    def sets(batches):
        shingler = Shingler(words)
        for batch in batches:
            found = [s for s in (shingler.set(t.as_py()) for t in batch.column(2)) if len(s)]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in found]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))],
                                             ["key", "shingles"])
    return docs.mapInArrow(sets, "key binary, shingles array<bigint>")


def _forest(keys, groups, sets, signs, similarity: int, matches: int) -> list[tuple]:
    """Links between different groups that join them, each confirmed on full sets."""
    m = len(keys)
    names, group = np.unique(np.array(groups), return_inverse=True)
    if len(names) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    _, column, uses = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), sizes)
    shared = np.cumsum(uses > 1) - 1
    some = uses[column] > 1
    owner, column = owner[some], shared[column[some]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((m, m), dtype=np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        a, b = np.searchsorted(column, [low, low + 2048])
        part = np.zeros((m, 2048), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        common += part @ part.T
    agree = np.zeros((m, m), dtype=np.int16)
    for values in signs.T:
        agree += values[:, None] == values[None, :]
    union = sizes[:, None] + sizes[None, :] - common
    near = (agree >= matches) & (100 * common >= similarity * union) & (group[:, None] != group[None, :])
    reached, out = np.zeros(len(names), dtype=bool), []
    members = [np.flatnonzero(group == g) for g in range(len(names))]
    for g in range(len(names)):
        if reached[g]:
            continue
        reached[g] = True
        stack = list(members[g])
        while stack:
            i = stack.pop()
            for j in np.flatnonzero(near[i]):
                if not reached[group[j]]:
                    reached[group[j]] = True
                    out.append((groups[i], groups[j]))
                    stack.extend(members[group[j]])
    return out


def _links(members: DataFrame, sets: DataFrame, similarity: int, matches: int) -> DataFrame:
    """Edges ``a, b`` between groups; ``members``: ``posting, n, weight, key, grp``."""
    sizes = members.groupBy("posting", "grp").agg(F.count(F.lit(1)).alias("m"))
    # pairs inside one group need no work: the largest group of a list is cut apart from
    # the rest, and its chunks meet the chunks of the rest but not each other
    tops = sizes.groupBy("posting").agg(F.max(F.struct("m", "grp")).alias("top"))
    own = members.join(tops, "posting").withColumn("big", F.when(F.col("top.m") > 1, F.col("top.m")).otherwise(0))
    chunks = lambda rows: F.ceil(rows * F.greatest(F.lit(1 / CHUNK_ROWS), F.col("weight") / F.col("n") / CHUNK_SHINGLES)).cast("int")
    own = own.withColumn("rest", chunks(F.col("n") - F.col("big"))).withColumn("most", chunks(F.col("big")))
    inside = (F.col("big") > 0) & (F.col("grp") == F.col("top.grp"))
    mix = F.xxhash64("key")
    own = own.withColumn("chunk", F.when(inside, F.col("rest") + F.pmod(mix, F.greatest("most", F.lit(1))))
                         .otherwise(F.pmod(mix, F.greatest("rest", F.lit(1)))).cast("int"))
    last = F.when(inside, F.col("rest")).otherwise(F.col("rest") + F.col("most")) - 1
    own = own.where(last >= 0)                # a list of one group has no rest to meet
    spread = own.select("posting", "key", "grp", "chunk", F.explode(F.sequence(F.lit(0), last)).alias("other"))
    pieces = spread.select("posting", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "key", "grp")
    full = pieces.join(sets, "key").select("posting", "i", "j", "grp", "key", "signature", "shingles")

    def merge(batches):
        held, rows = None, []

        def piece():
            keys, groups, signs, sets_ = zip(*rows)
            return _forest(keys, groups, sets_, np.stack(signs), similarity, matches) if len(rows) > 1 else []

        for batch in batches:
            place = list(zip(*(batch.column(k).to_pylist() for k in (0, 1, 2))))
            grp, key = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            found = []
            for r, at in enumerate(place):
                if at != held:
                    found += piece() if rows else []
                    held, rows = at, []
                rows.append((key[r], grp[r], batch.column(5)[r].values.to_numpy(), batch.column(6)[r].values.to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], ["a", "b"])
        if rows:
            found = piece()
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    dealt = full.repartition("posting", "i", "j").sortWithinPartitions("posting", "i", "j")
    return dealt.mapInArrow(merge, "a bigint, b bigint").distinct()


def groups(docs: DataFrame, words: int = 5, similarity: int = 80, coordinates: int = COORDINATES,
           matches: int = MATCHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, mark, key, n_shingles, component_id, kept``."""
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                      F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"), F.col(text_col).alias("text"))
    signed = staged(signatures(own, words, coordinates), "dedup-signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark"))
    classes = signed.where(F.col("key").isNotNull()).groupBy("key").agg(
        first.alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    # a class goes by a number from here on: postings and lists are what this operator shuffles most
    classes = settled(staged(classes.select(F.monotonically_increasing_id().alias("cid"), "key", "rep.doc_id", "rep.mark", "n_shingles",
                                            "signature"), "dedup-classes"))
    found, used = _components(own, classes, words, similarity, coordinates, matches)
    found = settled(staged(found, "dedup-components"))
    for table in used:
        dropped(table)
    named = classes.join(found.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.select("key", "doc_id", F.coalesce("component", "cid").alias("component"))
    ids = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    answer = named.join(ids, "component").select("key", "component_id")
    out = signed.join(answer, "key", "left")
    out = out.withColumn("component_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "mark", "key", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _components(docs, classes, words, similarity, coordinates, matches) -> tuple[DataFrame, list[DataFrame]]:
    """``node`` (class number), ``component``; and the staged tables it was made from."""
    classes = classes.withColumnRenamed("key", "digest").withColumnRenamed("cid", "key")
    postings = classes.select("key", "n_shingles", F.posexplode("signature").alias("c", "v"))
    postings = postings.select("key", "n_shingles", F.xxhash64("c", "v").alias("posting"))
    lists = postings.groupBy("posting").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight")).where("n > 1")
    shared = postings.join(lists, "posting").groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("n", "posting", "weight"))).alias("lists"))     # at most ``coordinates``
    shared = shared.where(F.size("lists") >= matches)
    prefix = F.slice("lists", F.lit(1), F.size("lists") - (matches - 1))
    shared = settled(staged(shared.select("key", prefix.alias("lists")), "dedup-prefixes"))
    # full sets of the classes that are left, from one row of each
    wanted = classes.join(shared.select("key"), "key").select("key", "digest", "doc_id", "mark", "signature")
    first_rows = staged(wanted.select(F.col("doc_id").alias("w_id"), F.col("mark").alias("w_mark")).distinct(), "dedup-wanted")
    rows = docs.join(counted(first_rows),
                     F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("mark") == F.col("w_mark")), "left_semi")
    sets = shingle_sets(rows.select("doc_id", "mark", "text"), words).withColumnRenamed("key", "digest").dropDuplicates(["digest"])
    sets = settled(staged(sets.join(wanted.select("key", "digest", "signature"), "digest").drop("digest"), "dedup-sets"))
    longest = shared.select("key", F.element_at("lists", -1).alias("l"))
    longest = longest.select("l.posting", "l.n", "l.weight", "key", F.col("key").alias("grp"))
    near = settled(components(_links(_counted(longest), sets, similarity, matches)))
    grouped = shared.join(near.withColumnRenamed("node", "key"), "key", "left")
    grouped = grouped.select(F.explode("lists").alias("l"), "key", F.coalesce("component", "key").alias("grp"))
    grouped = staged(grouped.select("l.posting", "l.n", "l.weight", "key", "grp"), "dedup-lists")
    open_lists = grouped.groupBy("posting").agg(F.min("grp").alias("low"), F.max("grp").alias("high"))
    open_lists = open_lists.where(F.col("low") != F.col("high")).select("posting")
    rest = grouped.join(open_lists, "posting")
    wide = components(_links(_counted(rest), sets, similarity, matches))
    merged = shared.select(F.col("key").alias("node")).join(near, "node", "left")
    merged = merged.select("node", F.coalesce("component", "node").alias("component"))
    wide = wide.select(F.col("node").alias("component"), F.col("component").alias("wider"))
    return merged.join(wide, "component", "left").select("node", F.coalesce("wider", "component").alias("component")), [shared, sets, grouped]


def _counted(members: DataFrame) -> DataFrame:
    """Members of lists that still have two or more, with the lists' present sizes."""
    sizes = members.groupBy("posting").agg(F.count(F.lit(1)).alias("m"))
    return members.join(sizes.where("m > 1"), "posting").select(
        "posting", F.col("m").alias("n"), F.least("weight", F.col("weight") * F.col("m") / F.col("n")).alias("weight"), "key", "grp")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """``docs`` with all its columns and one row of each component; rows without words all stay."""
    found = groups(docs, id_col=id_col, text_col=text_col, **parameters)
    stay = found.where(F.col("kept") & F.col("key").isNotNull()).select("doc_id", "mark").distinct()
    stay = stay.select(F.col("doc_id").alias("_stay_id"), F.col("mark").alias("_stay_mark"))
    rows = docs.withColumn("_mark", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    empty = found.where(F.col("key").isNull()).select(F.col("mark").alias("_empty")).distinct()
    kept = rows.join(stay, F.col(id_col).cast("bigint").eqNullSafe(F.col("_stay_id")) & (F.col("_mark") == F.col("_stay_mark")), "left_semi")
    kept = kept.dropDuplicates([id_col, "_mark"])
    none = rows.join(empty, F.col("_mark") == F.col("_empty"), "left_semi")
    return kept.unionByName(none).select(*docs.columns)
