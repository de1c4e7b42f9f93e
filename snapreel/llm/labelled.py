"""Bounded, balanced samples of labelled documents for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_CLASS = 2500        # labelled documents of each class that a fit reads at most
FIT_CHARS = 60_000      # longer documents are scored like any other but not fitted on


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose crc32 of the id as text leaves 1 modulo 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int = PER_CLASS, max_chars: int = FIT_CHARS,
           id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """``text, label`` of at most ``per_class`` documents a class, chosen by a hash of
    their id among the rows that are not held out, and all such rows' count by class."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("label")).distinct()
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picks = [known.where(F.col("label") == c).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(picks[0].union(picks[1]))           # at most 2 * per_class ids
    short = docs.where(F.char_length(F.col(text_col)) <= max_chars)
    return short.join(chosen, F.col(id_col) == F.col("_id")).select(F.col(text_col).alias("text"), "label"), counts


def prior_weights(labels, counts: dict[int, int]):
    """Weights that give a balanced sample the classes' real proportions (mean 1)."""
    import numpy as np
    labels = np.asarray(labels)
    share = {c: counts.get(c, 0) / max(1, (labels == c).sum()) for c in (0, 1)}
    w = np.where(labels == 1, share[1], share[0]).astype(float)
    return w / w.mean() if len(w) and w.sum() else np.ones(len(w))


def logistic(x, y, weights, penalty: float = 1e-3, steps: int = 60):
    """Weighted logistic regression by Newton steps; ``x`` has a column of ones."""
    import numpy as np
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weights * (p - y)) + penalty * w
        h = (x * (weights * p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
