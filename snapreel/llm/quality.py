"""Quality by a factorisation machine over hashed words, text structure and metadata.

A document's features are its words hashed into ``1 << WORD_BITS`` columns
(length-normalised root counts), statistics of its structure (how its
characters, words and lines are made and repeated) and metadata (its length).
The machine scores

    b + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2]

-- all pairwise interactions through ``FACTORS`` latent numbers a feature, in
time linear in the features present. It is trained by Adam on the logistic
loss over a bounded sample of labelled documents; the classes' real rates enter
as weights.

Defined cases: a null or empty text has no words and zero statistics and gets
the score of that; without labels of both classes every score is the rate of
label 1; repeated rows score alike; texts of any length are read whole; an
empty table gives no rows; other columns are ignored, and language, source and
id are never features.
"""

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapreel.llm import labelled

WORD_BITS, FACTORS = 12, 8
EPOCHS, BATCH, RATE, PENALTY = 40, 256, 0.01, 1e-4
STATISTICS = 18
FEATURES = (1 << WORD_BITS) + STATISTICS
# byte classes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 stops, 7 other ASCII symbols, 8 beyond ASCII
BYTE_CLASS = np.zeros(256, dtype=np.uint8)
for _bytes, _class in ((range(97, 123), 1), (range(65, 91), 2), (range(48, 58), 3), (b" \t", 4), (b"\n\r", 5),
                       (b".,;:!?'\"-", 6), (b"#$%&*()+/<=>@[\\]^_`{|}~", 7), (range(128, 256), 8)):
    BYTE_CLASS[list(_bytes)] = _class


class Reader:
    """``features(text)``: word columns, their values, and the statistics."""

    def __init__(self, cache_size: int = 400_000):
        self.cache: dict[str, int] = {}
        self.cache_size = cache_size

    def words(self, text: str) -> tuple[list[str], np.ndarray]:
        split = text.split()
        found = list(map(self.cache.get, split))
        if None in found:
            new = {w: crc32(w.lower().encode("utf-8", "surrogatepass")) for w, h in zip(split, found) if h is None}
            if len(self.cache) + len(new) > self.cache_size:
                self.cache.clear()
            self.cache.update(new)
            found = [new[w] if h is None else h for w, h in zip(split, found)]
        return split, np.array(found, dtype=np.int64)

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        text = text or ""
        split, hashed = self.words(text)
        n = len(split)
        if not n:
            return np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(STATISTICS)
        counts = np.bincount(hashed & ((1 << WORD_BITS) - 1), minlength=1 << WORD_BITS)
        at = np.flatnonzero(counts)
        values = np.sqrt(counts[at])
        values /= np.sqrt((values * values).sum())
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        kinds = np.bincount(BYTE_CLASS[raw], minlength=9) / len(raw)
        _, times = np.unique(hashed, return_counts=True)
        lines = text.split("\n")
        sizes = np.array([len(x) for x in lines], dtype=float)
        again = hashed[1:] == hashed[:-1]
        two = again[1:] & again[:-1] if n > 2 else np.zeros(1, dtype=bool)
        lone = sum(len(w) == 1 for w in split) / n
        marked = sum(w[-1] in "#$%&*|@^~" for w in split) / n
        stat = [*kinds[1:], np.log1p(n) / 10, len(text) / n / 20, len(times) / n, times.max() / n, again.mean() if n > 1 else 0,
                two.mean(), np.log1p(len(lines)) / 6, len(set(lines)) / len(lines), lone, marked]
        return at, values, np.array(stat)[:STATISTICS]


def predict(words: np.ndarray, values: np.ndarray, stats: np.ndarray, model) -> float:
    """The machine's value by the sum-of-squares identity, linear in the features."""
    bias, linear, factors, mean, scale = model
    at = np.concatenate([words, np.arange(1 << WORD_BITS, FEATURES)])
    x = np.concatenate([values, np.clip((stats - mean) / scale, -4, 4)])
    v = factors[at] * x[:, None]
    sums = v.sum(axis=0)
    return float(bias + linear[at] @ x + 0.5 * (sums @ sums - (v * v).sum()))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, counts: dict[int, int]):
    """``bias, linear, factors, mean, scale`` from the sampled documents' features."""
    labels = np.asarray(labels, dtype=float)
    rate = min(max(counts.get(1, 0) / max(1, sum(counts.values())), 1e-3), 1 - 1e-3)
    linear, mean, scale = np.zeros(FEATURES), np.zeros(STATISTICS), np.ones(STATISTICS)
    rng = np.random.default_rng(3)
    factors = rng.normal(0, 0.02, (FEATURES, FACTORS))
    bias = float(np.log(rate / (1 - rate)))
    if not (labels == 1).any() or not (labels == 0).any():
        return bias, linear, np.zeros_like(factors), mean, scale
    stats = np.stack([r[2] for r in rows])
    mean, scale = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    x = np.zeros((len(rows), FEATURES), dtype=np.float32)
    for row, (at, values, _) in zip(x, rows):
        row[at] = values
    x[:, 1 << WORD_BITS:] = np.clip((stats - mean) / scale, -4, 4)
    weight = labelled.prior_weights(labels, counts)
    parts = {"b": np.array([bias]), "w": linear, "v": factors}
    m = {k: np.zeros_like(p) for k, p in parts.items()}
    s = {k: np.zeros_like(p) for k, p in parts.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for k in range(0, len(rows), BATCH):
            pick = order[k:k + BATCH]
            xb, yb = x[pick].astype(np.float64), labels[pick]
            sums = xb @ parts["v"]
            squares = xb * xb
            value = parts["b"] + xb @ parts["w"] + 0.5 * ((sums * sums).sum(axis=1) - squares @ (parts["v"] ** 2).sum(axis=1))
            g = weight[pick] * (1 / (1 + np.exp(-np.clip(value, -30, 30))) - yb) / len(pick)
            grad = {"b": np.array([g.sum()]), "w": xb.T @ g + PENALTY * parts["w"],
                    "v": xb.T @ (sums * g[:, None]) - parts["v"] * (squares.T @ g)[:, None] + PENALTY * parts["v"]}
            step += 1
            for name, value in grad.items():
                m[name] = 0.9 * m[name] + 0.1 * value
                s[name] = 0.999 * s[name] + 0.001 * value * value
                parts[name] = parts[name] - RATE * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(s[name] / (1 - 0.999 ** step)) + 1e-8)
    return float(parts["b"][0]), parts["w"], parts["v"], mean, scale


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1500, **bounds):
    """Fit on a bounded sample of labelled documents (see :mod:`snapreel.llm.labelled`)."""
    rows, counts = labelled.sample(docs, labels, label, per_class=per_class, **bounds)

    def read(batches):
        reader = Reader()
        for batch in batches:
            found = [reader.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64())),
                 pa.array([f[2] for f in found], pa.list_(pa.float64())), batch.column(1)], ["at", "value", "stat", "label"])
    got = rows.mapInArrow(read, "at array<bigint>, value array<double>, stat array<double>, label int").toArrow()   # bounded by the sample
    at, value, stat, label_ = (got.column(k).to_pylist() for k in range(4))
    found = sorted(zip(at, value, stat, label_))
    return fit([(np.array(a, dtype=np.int64), np.array(v), np.array(t)) for a, v, t, _ in found],
               np.array([y for *_, y in found]), counts)


def scored(docs: DataFrame, model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 as ``out``, in one pass without a shuffle."""
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader()
        for batch in texts:
            value = np.array([predict(*reader.features(t), model) for t in batch], dtype=float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(value, -30, 30))))
    return docs.withColumn(out, F.pandas_udf(run, "double")(F.col(text_col)))
