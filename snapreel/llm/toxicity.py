"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

Units are a text's chunks: a word's letters without what stands between
them (``i-d-i-o-t``), a run of three or more lone letters (``i d i o t``), or a
join of two to four short neighbouring words (``id iot``, ``i di ot``); what
holds no letter (``i * d * i``) parts no neighbours. Joins are scored by what
whole words and lone letters taught; a fit does not learn from them. Chunks are folded to 30
letter classes and put between edge marks. The kernel of two chunks is the gap-weighted
subsequence kernel of length 3: every subsequence ``u`` of three letters spread
over at most ``SPAN`` places counts ``DECAY ** places``, so a word with letters
put in keeps most of its likeness. Chunks longer than ``WIDTH`` letters are
read in overlapping windows, whole.

Only documents are labelled, and no sentence is cut or labelled: the unit is a
chunk. Every chunk of a clean document is clean; a chunk of a toxic document is
toxic when it is several times as frequent in toxic documents as in clean ones
and, in each of a few rounds, the last round's SVM still found it toxic. Threats
and insults whose words are each common in clean text are therefore not learnt.
Landmarks are toxic chunks, the clean chunks most like them and the most frequent
clean ones; a linear SVM (squared hinge) is trained on the Nystroem features,
and a logistic fit turns a document's highest margin into a probability at the
labels' real rate.

A margin is linear in the kernel values, and these in a chunk's subsequences,
so the trained model is one weight per letter triple: a chunk costs its own
subsequences, no matter how many landmarks there are.

Defined cases: a null or empty text, or one without letters, scores the
margin of no chunk; without labels of both classes every score is the rate of
toxic labels; repeated rows score alike; texts and words of any length are
whole; an empty table gives no rows; other columns are ignored.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapreel.llm import labelled
from snapreel.llm.common import kept_by_worker, made_once

SPAN, DECAY, WIDTH = 6, 0.7, 24
EDGE = bytes([31])
LETTER_BITS = 5
CODES = 1 << (3 * LETTER_BITS)
GAPS = tuple((a, b) for a in range(1, SPAN) for b in range(1, SPAN) if a + b < SPAN)
LANDMARKS, CLEAN_LANDMARKS, NEGATIVES = 96, 48, 30_000
SEEN, EVIDENCE = 4, 1.5  # toxic documents that hold a chunk, and
# log ratio of a chunk's document rates from which it may be the insult
PENALTY, ROUNDS, CLEAN_WEIGHT = 3.0, 4, 100.0
NO_CHUNK = -3.0
JOINS = {2: 4, 3: 3, 4: 2}      # so many neighbouring words are joined when each has at most so many letters
FRAGMENT = max(JOINS.values())
TOGETHER, LEARNT = 50_000, 4096  # words of texts that are looked up, chunks that are learnt at once


def fold(word: str) -> bytes:
    """Letter classes 1-30 of the word's letters: a-z are 1-26, other letters share four."""
    if word.isascii():
        return word.encode("ascii").translate(ASCII_CLASSES, NO_LETTERS)
    return word.translate(CLASSES).encode("ascii")


def _letter_class(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else 27 + ord(letter) % 4


class _Classes(dict):
    """A translation table of all characters, filled as they come: what is no letter is left out."""

    def __missing__(self, code: int) -> str | None:
        self[code] = chr(_letter_class(chr(code))) if chr(code).isalpha() else None
        return self[code]


CLASSES = _Classes()
ASCII_CLASSES = bytes(_letter_class(chr(c)) if chr(c).isalpha() else 0 for c in range(128)) + bytes(128)
NO_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())


def windows(letters: bytes) -> list[bytes]:
    """The letters between two edge marks, in pieces of at most ``WIDTH``."""
    letters = EDGE + letters + EDGE
    if len(letters) <= WIDTH:
        return [letters]
    return [letters[k:k + WIDTH] for k in range(0, len(letters) - WIDTH // 2, WIDTH // 2)]


def subsequences(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, code, weight`` of each chunk's distinct letter triples (chunks of at most WIDTH)."""
    width = max(map(len, chunks), default=0)
    whole = np.int32 if len(chunks) <= 1 << (31 - 3 * LETTER_BITS - 3) else np.int64       # of a triple's key
    grid = np.frombuffer(b"".join([c.ljust(width, b"\0") for c in chunks]), dtype=np.uint8).reshape(len(chunks), width).astype(whole)
    keys = [np.zeros(0, dtype=whole)]
    rows = np.arange(len(chunks), dtype=whole)[:, None] << (3 * LETTER_BITS + 3)
    for a, b in GAPS:
        if a + b >= width:
            continue
        last = grid[:, a + b:]
        n = last.shape[1]
        code = (grid[:, :n] << (2 * LETTER_BITS)) | (grid[:, a:a + n] << LETTER_BITS) | last
        keys.append((rows | (code << 3) | (a + b + 1))[last > 0])       # letters stand without a break
    key = np.sort(np.concatenate(keys))
    if not len(key):
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0),)
    weight = (DECAY ** np.arange(8))[key & 7]
    same = key >> 3
    first = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
    same = same[first]
    return same >> (3 * LETTER_BITS), same & (CODES - 1), np.add.reduceat(weight, first)


def margins(chunks: list[bytes], table: np.ndarray, offset: float) -> np.ndarray:
    """The SVM margin of each chunk of at most WIDTH letters."""
    row, code, weight = subsequences(chunks)
    value = np.bincount(row, weight * table[code], minlength=len(chunks))
    norm = np.bincount(row, weight * weight, minlength=len(chunks))
    return np.where(norm > 0, value / np.sqrt(np.maximum(norm, 1e-12)) + offset, NO_CHUNK)


class Recent:
    """Values by key, made when first asked for. ``size`` bounds the entries: a full dictionary becomes
    the older one, from which entries still in use come back, and the one before it is dropped."""

    def __init__(self, make: Callable[[list[str]], list], size: int):
        self.make, self.size = make, size
        self.new: dict[str, object] = {}
        self.older: dict[str, object] = {}

    def find(self, keys: list[str]) -> list:
        found = list(map(self.new.get, keys))
        if None in found:
            unseen = {k for k, v in zip(keys, found) if v is None}
            fresh = {k: self.older[k] for k in unseen if k in self.older}
            made = [k for k in unseen if k not in fresh]
            fresh.update(zip(made, self.make(made)))
            if len(self.new) + len(fresh) > self.size:
                self.older, self.new = self.new, {}
            self.new.update(fresh)
            found = [fresh[k] if v is None else v for k, v in zip(keys, found)]
        return found


class Scorer:
    """``scores(texts)``: the highest margin of each text's chunks, with bounded caches of words and of their joins.

    New words are learnt for many texts at once, the shorter ones apart from the longer ones."""

    def __init__(self, table: np.ndarray, offset: float, cache_size: int = 300_000):
        self.table, self.offset, self.cache_size = table, offset, cache_size
        self.words = Recent(self.learn, cache_size // 2)       # margin and letters, up to one more than a fragment has
        self.joins = Recent(lambda joined: [margin for margin, _ in self.learn(joined)], cache_size // 2)

    def learn(self, words: list[str]) -> list[tuple[float, int]]:
        """Margin and number of letters (see ``words``) of each word."""
        owners, chunks, sizes = [], [], []
        for k, w in enumerate(words):
            letters = fold(w)
            sizes.append(min(len(letters), FRAGMENT + 1))
            if len(letters) < 2:                                         # a lone letter or none
                continue
            found = windows(letters)
            chunks += found
            owners += [k] * len(found)
        best = np.full(len(words), NO_CHUNK)
        owners = np.array(owners, dtype=np.int64)
        order = np.argsort(np.fromiter(map(len, chunks), np.int64, len(chunks)), kind="stable")
        for at in range(0, len(order), LEARNT):
            part = order[at:at + LEARNT]
            np.maximum.at(best, owners[part], margins([chunks[k] for k in part.tolist()], self.table, self.offset))
        return list(zip(best.tolist(), sizes))

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]

    def scores(self, texts: list[str | None]) -> list[float]:
        out, group, size = [], [], 0
        for text in texts:
            words = (text or "").lower().split()
            if len(words) > self.cache_size and len(words) > 100_000:    # a text of more words than the cache holds
                out += self._scored(group)
                out.append(max(self._scored([words[k:k + 100_000]])[0] for k in range(0, len(words), 99_900)))
                group, size = [], 0
                continue
            group.append(words)
            size += len(words)
            if size >= TOGETHER:
                out += self._scored(group)
                group, size = [], 0
        return out + self._scored(group)

    def _scored(self, texts: list[list[str]]) -> list[float]:
        """The highest margin of each of a few texts, given as their words."""
        found = self.words.find([w for words in texts for w in words])
        best, joined, ends, at = [], [], [], 0
        for words in texts:
            values, sizes = zip(*found[at:at + len(words)]) if words else ((), ())
            at += len(words)
            top = max([NO_CHUNK, *values])
            words, sizes = lettered(words, sizes)
            joined += fragments(words, sizes)
            ends.append(len(joined))
            for run in lone_runs(words, sizes == 1):
                top = max(top, float(margins(windows(run), self.table, self.offset).max()))
            best.append(top)
        found = self.joins.find(joined)
        return [max([top, *found[a:b]]) for top, a, b in zip(best, [0, *ends], ends)]


def lettered(words: list[str], sizes) -> tuple[list[str], np.ndarray]:
    """The words that hold a letter, and their numbers of letters."""
    sizes = np.array(sizes, dtype=np.int64)
    if not sizes.all():
        words = [words[k] for k in np.flatnonzero(sizes)]
    return words, sizes[sizes > 0]


def fragments(words: list[str], sizes: np.ndarray) -> set[str]:
    """Joins of short neighbouring words (see ``JOINS``) that have three letters or more."""
    found = set()
    for n, most in JOINS.items():
        if len(words) >= n:
            starts = len(words) - n + 1
            spans = np.stack([sizes[k:k + starts] for k in range(n)])
            at = np.flatnonzero((spans.max(axis=0) <= most) & (spans.sum(axis=0) > 2)).tolist()
            found.update("".join(words[k:k + n]) for k in at)
    return found


def lone_runs(words: list[str], lone: np.ndarray) -> list[bytes]:
    """Runs of three or more words of one letter, as one chunk each."""
    if lone.sum() < 3:
        return []
    edge = np.flatnonzero(np.diff(np.concatenate([[0], lone.astype(np.int8), [0]])))
    return [fold("".join(words[a:b])) for a, b in zip(edge[::2], edge[1::2]) if b - a >= 3]


def chunks_of(text: str) -> list[bytes]:
    """Distinct chunks of a text that have three letters or more, from whole words and lone letters: what a fit reads."""
    words = (text or "").lower().split()
    letters = [fold(w) for w in words]
    found = {c for x in letters if len(x) > 2 for c in windows(x)}
    words, sizes = lettered(words, [len(x) for x in letters])
    found.update(c for run in lone_runs(words, sizes == 1) for c in windows(run))
    return sorted(found)


def _kernel(chunks: list[bytes], basis: np.ndarray, codes: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Normalised kernel of chunks with the basis' chunks (rows: unit vectors over the triples ``codes``), in parts."""
    for at in range(0, len(chunks), 400):
        yield slice(at, at + 400), _unit(chunks[at:at + 400], codes) @ basis.T


def _codes(chunks: list[bytes]) -> np.ndarray:
    return np.unique(subsequences(chunks)[1])


def _unit(chunks: list[bytes], codes: np.ndarray | None = None) -> np.ndarray:
    """Unit vectors over all triples, or their parts over the sorted triples ``codes``."""
    row, code, weight = subsequences(chunks)
    weight = weight / np.sqrt(np.bincount(row, weight * weight, minlength=len(chunks)))[row]
    if codes is not None:
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        known = codes[at] == code
        row, code, weight = row[known], at[known], weight[known]
    dense = np.zeros((len(chunks), CODES if codes is None else len(codes)), dtype=np.float32)
    dense[row, code] = weight
    return dense


def _svm(x: np.ndarray, y: np.ndarray, weights: np.ndarray, penalty: float) -> np.ndarray:
    """Primal squared-hinge SVM by Newton steps; the last column of ``x`` is ones, for the offset."""
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        left, right = ridge.copy(), np.zeros(len(w))
        for at in range(0, len(x), 4096):                              # no copy of all rows
            part, sign = x[at:at + 4096], y[at:at + 4096]
            active = np.where(sign * (part @ w) < 1, weights[at:at + 4096], 0)
            left += part.T @ (part * active[:, None])
            right += part.T @ (active * sign)
        new = np.linalg.solve(left, right)
        if np.abs(new - w).max() < 1e-7:
            return new
        w = new
    return w


def fit(docs: list[list[bytes]], labels: np.ndarray, counts: dict[int, int]) -> tuple[np.ndarray, float, np.ndarray]:
    """``table, offset`` of the margins and the two coefficients of the probability.

    ``docs`` are the distinct chunks of each sampled document."""
    labels = np.asarray(labels)
    rate = counts.get(1, 0) / max(1, sum(counts.values()))
    if not (labels == 1).any() or not (labels == 0).any():
        level = np.log(max(rate, 1e-3) / max(1 - rate, 1e-3))
        return np.zeros(CODES), 0.0, np.array([0.0, level])
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    toxic: dict[bytes, int] = {}
    clean: dict[bytes, int] = {}
    for chunks, label in zip(docs, labels):
        into = toxic if label else clean
        for c in chunks:
            into[c] = into.get(c, 0) + 1
    # candidates for the insult: chunks several times as frequent in toxic documents as in clean ones
    odds = {c: np.log((n / n1) / ((clean.get(c, 0) + 0.5) / n0)) for c, n in toxic.items() if n >= SEEN}
    gain = {c: toxic[c] * r for c, r in odds.items() if r > EVIDENCE}
    if not gain:
        return np.zeros(CODES), 0.0, np.array([0.0, np.log(rate / (1 - rate))])
    ranked = sorted(gain, key=lambda c: (-gain[c], c))[:4 * LANDMARKS]
    units = _unit(ranked, _codes(ranked))
    likeness, chosen = units @ units.T, []
    for k in range(len(ranked)):
        if len(chosen) < LANDMARKS and (not chosen or likeness[k, chosen].max() < 0.9):
            chosen.append(k)
    marks = [ranked[k] for k in chosen]
    vocabulary = sorted((c for c in clean if c not in gain), key=lambda c: (-clean[c], c))
    frequent, negatives = vocabulary[:CLEAN_LANDMARKS], vocabulary[:NEGATIVES]
    # clean chunks most like the insults: the frequent ones first decide how far a likeness goes
    codes = _codes(marks)
    alike = np.concatenate([np.zeros(0), *(k.max(axis=1) for _, k in _kernel(negatives, _unit(marks, codes), codes))])
    close = [vocabulary[k] for k in np.argsort(-alike, kind="stable")[:LANDMARKS]]
    landmarks = marks + sorted({*frequent, *close})
    codes = _codes(landmarks)
    basis = _unit(landmarks, codes)                                    # over the landmarks' own triples only
    values, vectors = np.linalg.eigh((basis @ basis.T).astype(np.float64))
    keep = values > 1e-4
    root = vectors[:, keep] / np.sqrt(values[keep])                    # K^(-1/2) on its range

    toxic_chunks = sorted(gain)
    n = len(toxic_chunks)
    x = np.ones((n + len(negatives), keep.sum() + 1))
    for rows, chunks in ((x[:n], toxic_chunks), (x[n:], negatives)):
        for part, k in _kernel(chunks, basis, codes):
            rows[part, :-1] = k @ root
    y = np.where(np.arange(len(x)) < n, 1.0, -1.0)
    share = np.sqrt([clean[c] for c in negatives])        # a frequent clean chunk weighs more
    times = np.array([toxic[c] for c in toxic_chunks], dtype=float)
    held = np.ones(n, dtype=bool)
    for _ in range(ROUNDS):
        seen = times * held
        w = _svm(x, y, np.concatenate([seen, share * (CLEAN_WEIGHT * seen.sum() / share.sum())]), PENALTY)
        again = x[:n] @ w > 0                             # the others are like clean chunks: chance finds
        if not again.any() or (again == held).all():
            break
        held = again
    table = np.zeros(CODES)
    table[codes] = (root @ w[:-1]) @ basis
    offset = float(w[-1])
    top = np.array([max([NO_CHUNK, *margins(c, table, offset)]) if c else NO_CHUNK for c in docs])
    both = np.stack([top, np.ones(len(top))], axis=1)
    return table, offset, labelled.logistic(both, labels, labelled.prior_weights(labels, counts))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", **bounds):
    """Fit on a bounded sample of labelled documents (see :mod:`snapreel.llm.labelled`)."""
    rows, counts = labelled.sample(docs, labels, label, **bounds)

    def cut(batches):
        for batch in batches:
            texts, marks = (batch.column(k).to_pylist() for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array([chunks_of(t) for t in texts], pa.list_(pa.binary())),
                                              pa.array(marks, pa.int32())], ["chunks", "label"])
    found = rows.mapInArrow(cut, "chunks array<binary>, label int").toArrow()     # bounded by the sample
    docs_chunks = found.column("chunks").to_pylist()
    order = sorted(range(len(docs_chunks)), key=lambda k: docs_chunks[k])
    return fit([docs_chunks[k] for k in order], np.array(found.column("label").to_pylist(), dtype=int)[order], counts)


def scored(docs: DataFrame, model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic as ``out``, in one pass without a shuffle."""
    table, offset, (slope, level) = model
    table = table.astype(np.float32)
    kept = kept_by_worker(docs.sparkSession)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = made_once(kept, "scorer", lambda: Scorer(table, offset))
        for batch in texts:
            top = np.array(scorer.scores(batch.tolist()), dtype=float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(slope * top + level, -30, 30))))

    return docs.withColumn(out, F.pandas_udf(run, "double")(F.col(text_col)))
