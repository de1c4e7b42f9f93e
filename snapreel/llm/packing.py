"""Best-fit decreasing packing of token pieces into sequences of a fixed length.

Best-fit decreasing takes the pieces by falling length and puts each into the
open sequence with the least room that still fits. Which document a piece
comes from never matters to it, only how many pieces of each length there
are, and there are at most ``max_len`` lengths. So the packing itself is done
on that histogram (:func:`best_fit_plan`): a segment tree over the room left,
1 to ``max_len``, finds the tightest room in logarithmic time, and a run of
equal pieces meets a run of equally full sequences in one step: each of these
takes as many pieces as it has room for before the next is touched. The result is
the packing that document-by-document best-fit decreasing gives. It comes as
ranges -- "pieces ranked a to b of length L go to sequences s to s+b-a at
offset o" -- whose number depends on ``max_len`` and not on the number of
documents; pieces are ranked within their length on the cluster and joined to
their range.

Defined cases: a null or empty text is a document of one token, the end id;
equal lengths are ranked by a hash of the id and content, so ties and repeated
rows have a place each; an empty table gives no rows; a text of any length is
cut into whole ``max_len`` pieces and a rest; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapreel.llm.common import kept_by_worker, made_once, rank_in_buckets, staged
from snapreel.llm.tokens import IdEncoder

MAX_LEN = 2048
BUCKETS = 256           # hash pieces in which one length is ranked
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PIECE_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]


class RoomTree:
    """Segment tree over rooms 0..capacity: which rooms have open sequences."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.open = np.zeros(2 * self.size, dtype=bool)

    def set(self, room: int, value: bool) -> None:
        i = room + self.size
        self.open[i] = value
        while i > 1:
            i >>= 1
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """The smallest open room that is at least ``need``."""
        i = need + self.size
        if self.open[i]:
            return need
        while i > 1:                       # up to the first right sibling holding an open room
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.size:       # and down its leftmost open leaf
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_plan(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, int, int, int, int]]:
    """Ranges ``(length, first rank, last rank + 1, first sequence, offset)``."""
    tree = RoomTree(max_len)
    rooms: dict[int, deque] = {}           # room -> runs (first sequence, count)
    plan, opened = [], 0
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= max_len:
            raise ValueError(f"a piece of {length} tokens does not fit {max_len}")
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:               # open sequences, each filled before the next
                per = max_len // length
                full, rest = divmod(left, per)
                for count, fill in ((full, per), (1, rest)):
                    if count and fill:
                        for layer in range(fill):
                            plan.append((length, rank, rank + count, opened, layer * length))
                            rank += count
                        _put(rooms, tree, max_len - fill * length, opened, count)
                        opened += count
                break
            # the sequence just used has the tightest room for the next piece: each is filled before the next
            sequence, count = rooms[room].popleft()
            per = room // length
            full = min(count, left // per)
            rest = left - full * per if full < count else 0
            runs = ((sequence, full, per), (sequence + full, 1 if rest else 0, rest))
            used = full + (rest > 0)
            if used < count:
                rooms[room].appendleft((sequence + used, count - used))
            elif not rooms[room]:
                tree.set(room, False)
            for at, n, fill in runs:
                if n:
                    for layer in range(fill):
                        plan.append((length, rank, rank + n, at, max_len - room + layer * length))
                        rank += n
                    left -= n * fill
                    _put(rooms, tree, room - fill * length, at, n)
    return plan


def _put(rooms: dict[int, deque], tree: RoomTree, room: int, sequence: int, count: int) -> None:
    if room and count:
        rooms.setdefault(room, deque()).append((sequence, count))
        tree.set(room, True)


def pieces(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids and the end id, cut into pieces of at most ``max_len``."""
    kept = kept_by_worker(docs.sparkSession)

    def cut(batches):
        encoder = made_once(kept, "encoder", lambda: IdEncoder(tokenizer))
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * max_len)):
                    part = ids[at:at + 4 * max_len]
                    for column, value in zip(out, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECE_SCHEMA)


def pack(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, **columns) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``."""
    cut = staged(pieces(docs, tokenizer, max_len, **columns), "pack-pieces")
    counts = cut.groupBy("length").count().collect()      # at most max_len rows, whatever the input
    plan = best_fit_plan({r["length"]: r["count"] for r in counts}, max_len)
    keyed = cut.withColumn("mix", F.xxhash64("doc_id", "piece", "ids_crc32"))
    keyed = keyed.withColumn("bucket", F.pmod("mix", F.lit(BUCKETS)))
    ranked = rank_in_buckets(keyed, ["length"], "bucket", [F.col("mix"), F.col("doc_id"), F.col("start")], "rank")
    return place(ranked, plan)


def place(ranked: DataFrame, plan: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """Give each ranked piece the place that the range of its length and rank has.

    ``plan`` goes to the tasks whole: its size is bounded by ``max_len``."""
    ranges = np.array(sorted(plan), dtype=np.int64).reshape(-1, 5)
    lengths = np.unique(ranges[:, 0])
    begin = np.searchsorted(ranges[:, 0], lengths)

    def look_up(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.empty(len(length), dtype=np.int64)
            for value in np.unique(length):
                k = np.searchsorted(lengths, value)
                end = begin[k + 1] if k + 1 < len(begin) else len(ranges)
                mine = length == value
                at[mine] = begin[k] + np.searchsorted(ranges[begin[k]:end, 1], rank[mine], side="right") - 1
            found = ranges[at]
            columns = [*(batch.column(i) for i in range(5)),
                       pa.array(found[:, 3] + rank - found[:, 1]), pa.array(found[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, [*PIECE_COLUMNS, "sequence_id", "offset"])
    return ranked.select(*PIECE_COLUMNS, "rank").mapInArrow(look_up, f"{PIECE_SCHEMA}, sequence_id bigint, offset bigint")
