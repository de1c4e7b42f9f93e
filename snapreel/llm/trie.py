"""Conversation prefix trie: padded turn-id matrices, sorted and reduced depth by depth.

A node is a distinct sequence of first turns. Conversations become rows of turn
keys (16 bytes of a SHA-256 over role and text), rows are dealt to shards by
*range* of those keys, and a shard turns its rows into a matrix: one column a
turn, keys replaced by their rank in the shard, zeros where a conversation has
ended. ``numpy.lexsort`` orders it; a row starts a node of depth ``d`` where one
of its first ``d`` columns differs from the row above, a mask that is carried
from column to column by *or*. A node is then a stretch of rows, and
``reduceat`` over the stretches gives every depth's counts; sums over subtrees
come by going from the deepest column to the first.

Shards are ranges, so only the nodes on the path of a shard's first or last row
can have members elsewhere. A shard hands those on as two rows of partial
counts, and the same reduction over these rows finishes them (again in shards,
while they are more than one shard's work). Everything else is final.

No group is gathered: a conversation is cut into rows of ``WIDTH`` turns, each
keyed by its part and a 128-bit hash of all turns before it, so parts are
subtrees of their own whose sums are handed to the part before. Turns of one
very long conversation are ranked in pieces. The ids that end at a node are
hashed as joined pieces of a shard, in order.

Defined cases: null role and text are empty; turns are ordered by ``turn``, nulls
first, equal turns by their key; repeated rows are turns of their own; rows
without a conversation id belong to no conversation; an empty table has no
nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapreel.llm.common import counted, rank_in_buckets, staged

WIDTH = 32                  # turns of a row, and columns of a matrix
SHARD_CELLS = 1 << 19       # turns that a shard holds, about
SMALL_SHARD = 1 << 12       # a small table is spread over the session's partitions in shards of so many
HOT_TURNS = 1 << 16         # conversations with more turns are ranked in pieces
KEY = 16

ROW = {"part": "bigint", "p1": "bigint", "p2": "bigint", "conv_id": "bigint", "path": "binary", "sizes": "array<bigint>", "more": "bigint",
       "child": "bigint", "leaf": "bigint", "saved": "bigint", "cells": "array<bigint>"}
NODE = {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint",
        "saved_tokens": "bigint", "part": "bigint", "own_leaf": "bigint", "own_saved": "bigint", "node": "binary", "above": "binary",
        "ends": "binary"}
CELL = 6                    # numbers of a cell: members, least member, children, leaves, saved tokens, members that go on
NOBODY = np.iinfo(np.int64).max


def ordered(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``conv_id, pos, key, size``: every turn's place in its conversation, key and code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    word = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = staged(conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.substring(F.unhex(F.sha2(word, 256)), 1, KEY).alias("key"), F.char_length(text).cast("bigint").alias("size")), "trie-turns")
    by = [F.asc_nulls_first("turn"), F.col("key")]
    out = ["conv_id", "pos", "key", "size"]
    hot = staged(turns.groupBy("conv_id").count().where(F.col("count") > HOT_TURNS).select("conv_id"), "trie-hot")
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(*by)) - 1
    if hot.first() is None:
        return turns.withColumn("pos", place.cast("bigint")).select(*out)
    marked = counted(hot)
    usual = turns.join(marked, "conv_id", "left_anti").withColumn("pos", place.cast("bigint")).select(*out)
    piece = F.struct(F.col("turn").isNotNull(), F.coalesce(F.col("turn").cast("bigint"), F.lit(0)), F.substring("key", 1, 1))
    long = staged(turns.join(marked, "conv_id", "left_semi").withColumn("piece", piece), "trie-long")
    return usual.unionByName(rank_in_buckets(long, ["conv_id"], "piece", by, "pos").select(*out))


def rebuilt(turns: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """Conversations with the head of another: the first ``h`` turns of conversation ``c - c % every``, then
    the own turns after the first ``h``, where ``h = crc32(c) % heads``. Adds ``total``, the turns there are;
    a conversation without any has one row without ``pos``."""
    turns = staged(turns, "trie-ordered")
    sizes = staged(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    source = F.col("conv_id") - F.col("conv_id") % every
    convs = sizes.select("conv_id", "n", source.alias("source"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"))
    of_source = sizes.select(F.col("conv_id").alias("source"), F.col("n").alias("n_source"))
    taken = F.least("h", F.coalesce("n_source", F.lit(0)))
    convs = convs.join(of_source, "source", "left").select(
        "conv_id", "source", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"))
    convs = staged(convs, "trie-convs")
    head = turns.where((F.col("pos") < heads) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "source")
    first = convs.join(head, "source").where(F.col("pos") < F.col("h"))
    own = turns.join(convs, "conv_id").where(F.col("pos") >= F.col("h")).withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    bare = convs.where(F.col("total") == 0).select("conv_id", *[F.lit(None).alias(c) for c in ("pos", "key", "size")], "total")
    out = ["conv_id", "pos", "key", "size", "total"]
    return first.select(*out).unionByName(own.select(*out)).unionByName(bare)


def with_totals(turns: DataFrame) -> DataFrame:
    """Ordered turns with ``total``, the number of turns of their conversation."""
    turns = staged(turns, "trie-ordered")
    return turns.join(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("total")), "conv_id")


def rows_of(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """Conversations cut into rows of ``width`` turns. A conversation whose turns fill its rows has
    an empty one after them, so that a part's rows are all that reach its top."""
    turns = staged(turns, "trie-rebuilt")
    part = F.expr(f"pos div {width}")
    real = turns.where(F.col("pos").isNotNull()).withColumn("part", part)
    salted = [F.xxhash64(F.lit(k), "key", "pos") for k in (1, 2)]
    rows = real.groupBy("conv_id", "part", "total").agg(
        F.sort_array(F.collect_list(F.struct("pos", "key", "size"))).alias("turns"),
        F.bit_xor(salted[0]).alias("x1"), F.bit_xor(salted[1]).alias("x2"))
    rows = staged(rows.select("conv_id", "part", "total", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), "")).alias("path"),
                              F.transform("turns", lambda t: t["size"]).alias("sizes"), "x1", "x2"), "trie-rows")
    full = (turns.where(F.col("total") % width == 0).select("conv_id", "total").distinct().select(
            "conv_id", F.expr(f"total div {width}").alias("part"), "total", F.lit(b"").alias("path"),
                    F.array().cast("array<bigint>").alias("sizes"), F.lit(0).cast("bigint").alias("x1"), F.lit(0).cast("bigint").alias("x2")))
    rows = rows.unionByName(full)
    later = rows.where(F.col("total") >= width).select("conv_id", "part", "x1", "x2")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = later.select("conv_id", "part", *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(p) for x, p in (("x1", "p1"), ("x2", "p2"))])
    tops = rows.where(F.col("part") == 0).withColumns({"p1": F.lit(0).cast("bigint"), "p2": F.lit(0).cast("bigint")})
    rest = rows.where(F.col("part") > 0).join(starts, ["conv_id", "part"])
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("child", "leaf", "saved")]
    out = ["part", "p1", "p2", "conv_id", "path", "sizes", (F.col("total") > (F.col("part") + 1) * width).cast("bigint").alias("more"), *zero,
           F.lit(None).cast("array<bigint>").alias("cells")]
    return tops.select(*out).unionByName(rest.select(*out))


class Matrix:
    """The rows of one shard as a sorted, padded matrix of turn ids."""

    def __init__(self, rows: dict, width: int):
        n = len(rows["conv_id"])
        length = np.array([len(p) // KEY for p in rows["path"]], np.int64)
        keys = np.frombuffer(b"".join(rows["path"]), ">u8").astype(np.uint64).reshape(-1, 2)
        by = np.lexsort((keys[:, 1], keys[:, 0]))
        differs = np.ones(len(keys), bool)
        differs[1:] = (keys[by][1:] != keys[by][:-1]).any(axis=1)
        ids = np.empty(len(keys), np.int32)
        ids[by] = np.cumsum(differs)
        wide = int(length.max(initial=0))
        matrix, size = np.zeros((n, wide), np.int32), np.zeros((n, wide), np.int64)
        at = np.arange(wide)[None, :] < length[:, None]
        matrix[at] = ids
        size[at] = np.concatenate([np.asarray(s, np.int64) for s in rows["sizes"]]) if len(keys) else 0
        last = {c: np.array(rows[c], np.int64) for c in ("more", "child", "leaf", "saved", "conv_id", "part", "p1", "p2")}
        order = np.lexsort((last["conv_id"], last["more"], *matrix.T[::-1], last["p2"], last["p1"], last["part"]))
        self.matrix, self.size, self.length = matrix[order], size[order], length[order]
        self.last = {c: v[order] for c, v in last.items()}
        self.path = [rows["path"][k] for k in order.tolist()]
        self.wide, self.n = wide, n
        cells = [rows["cells"][k] for k in order.tolist()]
        self.cells = None
        if n and cells[0] is not None:
            self.cells = np.zeros((n, wide + 1, CELL), np.int64)
            self.cells[:, :, 1] = NOBODY
            for k, c in enumerate(cells):
                self.cells[k, :self.length[k] + 1] = np.array(c, np.int64).reshape(-1, CELL)
        top = np.stack([self.last[c] for c in ("part", "p1", "p2")], axis=1)
        mask = np.ones(n, bool)
        mask[1:] = (top[1:] != top[:-1]).any(axis=1)
        self.starts = [np.flatnonzero(mask)]                  # of depth 0 .. wide, stretches that have ended included
        for d in range(wide):
            mask = mask.copy()
            mask[1:] |= self.matrix[1:, d] != self.matrix[:-1, d]
            self.starts.append(np.flatnonzero(mask))

    def cell(self, d: int) -> list[np.ndarray]:
        """The six numbers of every row at depth ``d``; nothing where a row has ended."""
        if self.cells is not None:
            return [self.cells[:, d, k] for k in range(CELL)]
        here, end = self.length >= d, self.length == d
        return [here.astype(np.int64), np.where(here, self.last["conv_id"], NOBODY),
                *(np.where(end, self.last[c], 0) for c in ("child", "leaf", "saved", "more"))]

    def name(self, row: int, d: int) -> bytes:
        top = ",".join(str(int(self.last[c][row])) for c in ("part", "p1", "p2"))
        return hashlib.sha256(top.encode() + b";" + self.path[row][:KEY * d]).digest()


def reduce(m: Matrix, cut: bool, width: int) -> tuple[list, list, list]:
    """``(nodes, edge rows, pieces of end ids)`` of a shard; without ``cut`` every node is final."""
    if not m.n:
        return [], [], []
    edges = [0, m.n - 1] if cut else []
    leaf, saved, kid = np.zeros(m.n, np.int64), np.zeros(m.n, np.int64), np.zeros(m.n, np.int64)
    partial: dict[tuple[int, int], list[int]] = {}
    depths = []
    for d in range(m.wide, -1, -1):
        start = m.starts[d]
        real = m.length[start] >= d
        n, low, child, own_leaf, own_saved, more = m.cell(d)
        leaf += own_leaf
        saved += own_saved
        total = {k: np.add.reduceat(v, start) for k, v in
                 (("n", n), ("child", child + kid), ("leaf", leaf), ("saved", saved), ("more", more))}
        total["low"] = np.minimum.reduceat(low, start)
        on_edge = np.zeros(len(start), bool)
        for k, row in enumerate(edges):
            if m.length[row] >= d:
                at = int(np.searchsorted(start, row, side="right")) - 1
                if not on_edge[at]:
                    partial[k, d] = [int(total[c][at]) for c in ("n", "low", "child", "leaf", "saved", "more")]
                    end = start[at + 1] if at + 1 < len(start) else m.n
                    leaf[start[at]:end] = saved[start[at]:end] = 0        # handed on with the edge
                on_edge[at] = True
        ends_here = (total["child"] == 0) & (total["more"] == 0) & real & ~on_edge
        spared = np.where(real & ~on_edge & (d > 0), (total["n"] - 1) * (m.size[start, d - 1] if d else 0), 0)
        leaf[start] += ends_here
        saved[start] += spared
        kid = np.zeros(m.n, np.int64)
        kid[start] = real & ~on_edge
        depths.append((d, start, real & ~on_edge, total, ends_here.astype(np.int64), spared))
    nodes, pieces = [], []
    depths.reverse()
    for d, start, final, total, own_leaf, own_saved in depths:
        if d:                                      # the stretch above; an edge's least member is not known here
            _, tops, sure, up, _, _ = depths[d - 1]
            at = np.searchsorted(tops, start, side="right") - 1
            parent, known = up["low"][at], sure[at]
        closes = np.append(start[1:], m.n)
        for k in np.flatnonzero(final | (m.cells is None)).tolist():
            row, ids = int(start[k]), ""
            if m.length[row] == d and not m.last["more"][row] and m.cells is None:      # the rows that end here come first
                span = slice(row, int(closes[k]))
                ending = (m.length[span] == d) & (m.last["more"][span] == 0)
                ids = ",".join(map(str, m.last["conv_id"][span][ending].tolist()))
            if not final[k]:
                if ids and m.length[row] >= d and (d or m.last["part"][row] == 0):
                    pieces.append((m.name(row, d), int(m.last["conv_id"][row]), ids))
                continue
            part = int(m.last["part"][row])
            nodes.append((int(total["low"][k]), part * width + d, int(parent[k]) if d and known[k] else None, int(total["n"][k]), int(total["child"][k]),
                          int(total["leaf"][k] + own_leaf[k]), int(total["saved"][k] + own_saved[k]), part, int(own_leaf[k]), int(own_saved[k]),
                          None if m.cells is None else m.name(row, d), m.name(row, d - 1) if d and not known[k] else None, None if m.cells is not None else hashlib.sha256(ids.encode()).digest()))
    rows = []
    for k, row in enumerate(edges):
        if any(e == k for e, _ in partial):
            cells = [v for d in range(int(m.length[row]) + 1) for v in partial.get((k, d), [0, NOBODY, 0, 0, 0, 0])]
            rows.append((*(int(m.last[c][row]) for c in ("part", "p1", "p2", "conv_id")), m.path[row], m.size[row, :m.length[row]].tolist(),
                         0, 0, 0, 0, cells))
    return nodes, rows, pieces


NODES, EDGE, PIECE = 0, 1, 2       # kinds of rows that a shard gives
ARROW = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}


def ddl(fields: dict[str, str], sign: str = " ") -> str:
    return ", ".join(f"{name}{sign}{kind}" for name, kind in fields.items())


def shards_of(rows: DataFrame, cut: bool, width: int) -> DataFrame:
    """Every shard's nodes, edge rows and pieces (one row each, told apart by ``kind``)."""
    own = {"kind": "int", **NODE}
    schema = pa.schema([(c, ARROW[t]) for c, t in own.items()]
                       + [("edge", pa.struct([(c, ARROW[t]) for c, t in ROW.items()])), ("first", pa.int64()), ("ids", pa.string())])

    def run(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for name, column in zip(batch.schema.names, batch.columns):
                held.setdefault(name, []).extend(column.to_pylist())
        if not held:
            return
        nodes, edges, pieces = reduce(Matrix(held, width), cut, width)
        del held
        bare = dict.fromkeys(NODE)
        out = [(NODES, *n, None, None, None) for n in nodes]
        out += [(EDGE, *bare.values(), dict(zip(ROW, e)), None, None) for e in edges]
        out += [(PIECE, *(bare | {"node": name}).values(), None, first, ids) for name, first, ids in pieces]
        for at in range(0, len(out), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[at:at + 4096]), schema)], schema=schema)

    return rows.select(*ROW).mapInArrow(run, f"{ddl(own)}, edge struct<{ddl(ROW, ':')}>, first bigint, ids string")


def joined_ends(pieces: DataFrame) -> DataFrame:
    """``node, ends``: the SHA-256 of each node's joined ids, pieces taken in ascending order."""
    def run(batches):
        name, state = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != name:
                    if state is not None:
                        done.append((name, state.digest()))
                    name, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in done], pa.binary()) for c in (0, 1)], ["node", "ends"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.digest()], pa.binary())], ["node", "ends"])
    return pieces.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(run, "node binary, ends binary")


def part_nodes(rows: DataFrame, width: int) -> DataFrame:
    """The nodes of every part's own trie, sums over later parts taken from the rows."""
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done, pieces = [], None
    while True:
        cells = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
        shards = max(-(-cells // SHARD_CELLS), min(spread, -(-cells // SMALL_SHARD)), 1) if pieces is None else -(-cells // SHARD_CELLS)
        cut = shards > 1
        dealt = rows.repartitionByRange(shards, "part", "p1", "p2", "path", "more", "conv_id") if cut else rows.repartition(1)
        found = staged(shards_of(dealt, cut, width), "trie-found")
        done.append(found.where(F.col("kind") == NODES).select(*NODE))
        if pieces is None:
            pieces = found.where(F.col("kind") == PIECE)
        if not cut:
            break
        rows = found.where(F.col("kind") == EDGE).select("edge.*")
    nodes = done[0]
    if len(done) > 1:
        shared = done[1]
        for more in done[2:]:
            shared = shared.unionByName(more)
        none = F.unhex(F.sha2(F.lit("").cast("binary"), 256))
        whole = shared.drop("ends").join(joined_ends(pieces), "node", "left").withColumn("ends", F.coalesce("ends", none))
        least = shared.select(F.col("node").alias("above"), F.col("conv_id").alias("_least"))
        nodes = nodes.unionByName(whole.select(*NODE)).join(counted(least), "above", "left")
        nodes = nodes.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_least")).select(*NODE)
    return nodes


def nodes(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the trie over ``turns`` (``conv_id, pos, key, size, total``): ``conv_id`` (least member),
    ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens`` and ``ends``, the SHA-256 of the ids ending there."""
    rows = staged(rows_of(turns, width), "trie-parts")
    later = rows.where(F.col("part") > 0)
    if later.first() is not None:
        inner = staged(part_nodes(later, width), "trie-inner")
        top = inner.where(F.col("depth") == F.col("part") * width)
        own = inner.where(F.col("depth") > F.col("part") * width).groupBy("conv_id", "part").agg(
            F.sum("own_leaf").alias("leaf"), F.sum("own_saved").alias("saved"))
        after = Window.partitionBy("conv_id").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, 0)
        every = later.select("conv_id", "part").join(own, ["conv_id", "part"], "left").select(
            "conv_id", (F.col("part") - 1).alias("part"), *[F.sum(F.coalesce(c, F.lit(0))).over(after).alias(f"_{c}") for c in ("leaf", "saved")])
        children = top.select("conv_id", (F.col("part") - 1).alias("part"), F.col("n_children").alias("_child"))
        sums = staged(every.join(children, ["conv_id", "part"], "left"), "trie-sums")
        rows = rows.drop("child", "leaf", "saved").join(sums, ["conv_id", "part"], "left").select(
            *[F.coalesce(f"_{c}", F.lit(0)).alias(c) if c in ("child", "leaf", "saved") else F.col(c) for c in ROW])
        rows = staged(rows, "trie-whole")
    found = part_nodes(rows, width)
    whole = found.where((F.col("part") == 0) | (F.col("depth") > F.col("part") * width))
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.lower(F.hex("ends")).alias("ends_sha256"))
