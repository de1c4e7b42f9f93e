"""Adaptive context-mixing range coder for token ids, in independent blocks.

A block holds ``n`` ids cut into lanes of consecutive ids that are coded side
by side, one numpy step for all lanes, each lane with a range coder of its own.
All lanes share the block's adaptive model, which starts empty in every block:

* order 2 and order 1 predict the next id from the last two ids and the last
  one (hashed tables of the id seen last there, with a confidence of 0 to 3);
* for every combination of confidences and agreement, counts of which order
  was right give the weights with which the predictions are mixed. The coder
  first codes the lowest-ranked component that holds the id: the order-2
  prediction, the order-1 prediction or order 0;
* order 0 codes an id by the frequencies of ids that the predictions missed.

The decoder repeats the model's steps, so nothing but the coded words, the
lanes' word counts and a header with two checksums is stored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

HEADER = "<4sBxxxIQIIII"                       # magic, version, vocabulary, n, steps, lanes, crc of ids, crc of body
MAGIC, VERSION = b"CMRC", 1
STEPS = 512                                   # aimed-at ids in a lane
MAX_LANES = 8192
HASH_BITS = 18
WEIGHT_BITS = 12                              # mixing weights add up to 1 << 12
REBUILD = 8                                   # order 0 is renewed after 1, 2, 4, 8, 16, 24, ... steps
U32, U64 = np.uint32, np.uint64
LOW_WORD = U64(0xFFFFFFFF)
WORD = U64(32)
# confidence after a right or wrong prediction; a wrong one is replaced at confidence 0 and 1
AFTER = np.array([[1, 1, 1, 2], [1, 2, 3, 3]], dtype=np.int32)


class _Model:
    """The shared predictor. ``predict`` for a step's lanes, then ``learn`` the ids."""

    def __init__(self, vocabulary: int, lanes: int):
        self.vocabulary = vocabulary
        self.one = np.zeros(vocabulary + 1, dtype=np.int32)       # id * 4 + confidence
        self.two = np.zeros(1 << HASH_BITS, dtype=np.int32)
        self.last = np.full(lanes, vocabulary, dtype=np.int64)    # a lane starts after no id
        self.before = np.full(lanes, vocabulary, dtype=np.int64)
        prior = np.ones((4, 4, 2, 3))
        prior[..., 0] += np.array([0, 4, 10, 20])[:, None, None]
        prior[..., 1] += np.array([0, 2, 4, 6])[None, :, None]
        prior[..., 2] += 4
        self.votes = prior.reshape(32, 3)
        self.missed = np.zeros(vocabulary, dtype=np.int64)
        self.recent: list[np.ndarray] = []
        self.step = 0
        self._order0()
        self._weights()

    def _order0(self) -> None:
        if self.recent:
            self.missed += np.bincount(np.concatenate(self.recent), minlength=self.vocabulary)
            self.recent = []
        total = int(self.missed.sum())
        spread = (1 << 20) // (total + 1) + 1                     # counts weigh more than the floor of 1
        self.frequency = (self.missed * spread + 1).astype(U64)
        self.cumulative = np.zeros(self.vocabulary + 1, dtype=U64)
        np.cumsum(self.frequency, out=self.cumulative[1:])
        self.total = self.cumulative[-1]

    def _weights(self) -> None:
        whole = (1 << WEIGHT_BITS) - 3
        share = np.floor(self.votes * (whole / self.votes.sum(axis=1, keepdims=True))).astype(np.int64) + 1
        share[:, 2] += (1 << WEIGHT_BITS) - share.sum(axis=1)
        start = np.zeros_like(share)
        np.cumsum(share[:, :2], axis=1, out=start[:, 1:])
        self.share, self.start = share.ravel().astype(U64), start.ravel().astype(U64)
        self.first, self.second = start[:, 1].astype(U64), start[:, 2].astype(U64)

    def predict(self, lanes: int) -> None:
        last, before = self.last[:lanes], self.before[:lanes]
        self.at1 = last
        mixed = last * 0x85EBCA6B + before * 0x9E3779B1
        self.at2 = (mixed ^ (mixed >> 15)) & ((1 << HASH_BITS) - 1)
        self.e1, self.e2 = self.one[self.at1], self.two[self.at2]
        self.id1, self.id2 = self.e1 >> 2, self.e2 >> 2
        self.state = (((self.e2 & 3) * 4 + (self.e1 & 3)) * 2 + (self.id1 == self.id2)).astype(np.int64)

    def learn(self, ids: np.ndarray, component: np.ndarray, missed: np.ndarray) -> None:
        self.votes += np.bincount(self.state * 3 + component, minlength=96).reshape(32, 3)
        if self.step % 4 == 0:
            self.votes[self.votes.sum(axis=1) > 1 << 16] *= 0.5
            self._weights()
        if len(missed):
            self.recent.append(missed)
        for table, at, entry, guess in ((self.one, self.at1, self.e1, self.id1), (self.two, self.at2, self.e2, self.id2)):
            right = ids == guess
            sure = entry & 3
            table[at] = np.where(right | (sure > 1), guess, ids) * 4 + AFTER[right.view(np.int8), sure]
        n = len(ids)
        self.before[:n] = self.last[:n]
        self.last[:n] = ids
        self.step += 1
        if self.step % REBUILD == 0 or self.step & (self.step - 1) == 0:
            self._order0()


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(MAX_LANES, n // STEPS))
    steps = -(-n // lanes)
    return steps, -(-n // steps)


def _renormalise(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Lanes whose top word is settled, or whose width is cut to settle it."""
    settled = ((low ^ (low + width - U64(1))) >> WORD) == 0
    narrow = (width <= LOW_WORD) & ~settled
    if narrow.any():
        width[narrow] = LOW_WORD + U64(1) - (low[narrow] & LOW_WORD)
    return np.flatnonzero(settled | narrow)


def encode(ids: np.ndarray, vocabulary: int | None = None) -> bytes:
    """One block. ``ids`` are below 2**29; ``vocabulary`` is at least their maximum + 1."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    n = len(ids)
    top = int(ids.max()) + 1 if n else 1
    vocabulary = max(vocabulary or top, top)
    if vocabulary > 1 << 29:
        raise ValueError(f"id {vocabulary - 1} is too large")
    checksum = zlib.crc32(ids.tobytes())
    if not n:
        return struct.pack(HEADER, MAGIC, VERSION, vocabulary, 0, 0, 0, checksum, 0)
    steps, lanes = _shape(n)
    grid = np.zeros(steps * lanes, dtype=np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    short = n - (lanes - 1) * steps                               # ids in the last lane
    model = _Model(vocabulary, lanes)
    low, width = np.zeros(lanes, dtype=U64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=U64)
    out_lanes: list[np.ndarray] = []
    out_words: list[np.ndarray] = []

    def emit(at, lo, wi):
        out_lanes.append(at.astype(np.int32))
        out_words.append((lo >> WORD).astype(U32))
        return lo << WORD, wi << WORD

    for t in range(steps):
        active = lanes if t < short else lanes - 1
        x = grid[t, :active]
        model.predict(active)
        hit2 = x == model.id2
        component = np.where(hit2, 0, np.where(x == model.id1, 1, 2))
        which = model.state * 3 + component
        lo, wi = low[:active], width[:active]
        part = wi >> U64(WEIGHT_BITS)
        lo += model.start[which] * part
        wi[:] = model.share[which] * part
        at = _renormalise(lo, wi)
        lo[at], wi[at] = emit(at, lo[at], wi[at])
        at0 = np.flatnonzero(component == 2)
        missed = x[at0]
        if len(at0):
            lo0, wi0 = lo[at0], wi[at0]
            part = wi0 // model.total
            lo0 += model.cumulative[missed] * part
            wi0 = model.frequency[missed] * part
            done = _renormalise(lo0, wi0)
            lo0[done], wi0[done] = emit(at0[done], lo0[done], wi0[done])
            lo[at0], wi[at0] = lo0, wi0
        model.learn(x, component, missed)
    out_lanes.append(np.arange(lanes, dtype=np.int32))
    out_words.append(((low + width - U64(1)) >> WORD).astype(U32))
    lane = np.concatenate(out_lanes)
    words = np.concatenate(out_words)[np.argsort(lane, kind="stable")]
    body = np.bincount(lane, minlength=lanes).astype("<u4").tobytes() + words.astype("<u4").tobytes()
    return struct.pack(HEADER, MAGIC, VERSION, vocabulary, n, steps, lanes, checksum, zlib.crc32(body)) + body


def decode(block: bytes) -> np.ndarray:
    """The ids of one block (``<u4``); raises ``ValueError`` when a checksum fails."""
    magic, version, vocabulary, n, steps, lanes, checksum, body_crc = struct.unpack_from(HEADER, block)
    body = memoryview(block)[struct.calcsize(HEADER):]
    if magic != MAGIC or version != VERSION or (n and zlib.crc32(body) != body_crc):
        raise ValueError("not a block, or a damaged one")
    if not n:
        return np.zeros(0, dtype="<u4")
    counts = np.frombuffer(body, dtype="<u4", count=lanes).astype(np.int64)
    words = np.concatenate([np.frombuffer(body, dtype="<u4", offset=4 * lanes), np.zeros(1, dtype="<u4")]).astype(U64)
    end = np.cumsum(counts)
    place = end - counts
    blank = len(words) - 1                                        # a zero, read beyond a lane's end

    def take(at):
        here = place[at]
        place[at] = here + 1
        return words[np.where(here < end[at], here, blank)]

    every = np.arange(lanes)
    code = take(every) << WORD
    code |= take(every)
    short = n - (lanes - 1) * steps
    model = _Model(vocabulary, lanes)
    low, width = np.zeros(lanes, dtype=U64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=U64)
    grid = np.zeros((steps, lanes), dtype="<u4")
    for t in range(steps):
        active = lanes if t < short else lanes - 1
        model.predict(active)
        lo, wi, co = low[:active], width[:active], code[:active]
        part = wi >> U64(WEIGHT_BITS)
        value = (co - lo) // part
        component = (value >= model.first[model.state]).astype(np.int64) + (value >= model.second[model.state])
        which = model.state * 3 + component
        lo += model.start[which] * part
        wi[:] = model.share[which] * part
        at = _renormalise(lo, wi)
        lo[at], wi[at] = lo[at] << WORD, wi[at] << WORD
        co[at] = (co[at] << WORD) | take(at)
        x = np.where(component == 0, model.id2, model.id1).astype(np.int64)
        at0 = np.flatnonzero(component == 2)
        missed = x[at0]
        if len(at0):
            lo0, wi0, co0 = lo[at0], wi[at0], co[at0]
            part = wi0 // model.total
            value = np.minimum((co0 - lo0) // part, model.total - U64(1))
            missed = np.searchsorted(model.cumulative, value, side="right") - 1
            lo0 += model.cumulative[missed] * part
            wi0 = model.frequency[missed] * part
            done = _renormalise(lo0, wi0)
            lo0[done], wi0[done] = lo0[done] << WORD, wi0[done] << WORD
            co0[done] = (co0[done] << WORD) | take(at0[done])
            lo[at0], wi[at0], co[at0] = lo0, wi0, co0
            x[at0] = missed
        model.learn(x, component, missed)
        grid[t, :active] = x
    ids = np.ascontiguousarray(grid.T).reshape(-1)[:n]
    if zlib.crc32(ids.tobytes()) != checksum:
        raise ValueError("the decoded ids fail their checksum")
    return ids
