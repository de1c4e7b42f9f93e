"""BPE encoding and decoding by a tokenization automaton.

The merges of a vocabulary are compiled into a deterministic automaton over
*tokens* that accepts exactly the token sequences BPE produces. It starts as
one state with a loop for every single-byte token, and every merge
``(u, v) -> w``, in order of rank, is worked in by its gadget: where an arc
``u`` leads to a state with an arc ``v``, the arc ``u`` is led to a copy of that
state without the arc ``v``, and an arc ``w`` goes straight to where ``u v`` led.
So after ``u`` no ``v`` can follow, and the pair is spelt ``w``.

All arcs of one label lead to one state, which is kept per token (``target``).
An arc ``w`` exists where an arc ``u`` exists when ``w`` is made: what a copy loses
besides ``v`` are the tokens made later that begin with ``v``. Numbered in
preorder of the tree "token -> its left part", later tokens first, these are one
interval, so a state's arcs are all tokens but those in a few intervals, and
``target`` and the intervals' sorted bounds are the whole transition table.

A pre-split word is encoded by walking its symbols (bytes, the last one marked
as a word's end): the vocabulary's trie names the tokens that go on from a
position, and the table says which of them have arcs from the state reached
there; one path spells the word, and longer tokens are tried first. Decoding emits the labels of the arcs.

Texts are cut as the tokenizer file says (special tokens, NFC, white space,
lower case, word pattern); :class:`~snapreel.llm.tokens.IdEncoder` keeps the
words it has seen, new ones go through the automaton. Texts outside the
characters it can cut are cut by the library's own normaliser and pre-splitter.

Defined cases: a null or empty text has no ids and decodes to an empty text;
repeated rows are encoded alike; texts are encoded whole whatever their length;
an empty table gives no rows; an existing column of the output's name is
replaced, other columns are kept.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_right
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapreel.llm.common import kept_by_worker, made_once
from snapreel.llm.tokens import IdEncoder

END = 256               # added to the last byte of a word
START = -1              # the start state: every token has an arc
KEPT_WORD = 200         # longer words are encoded each time instead of being kept


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Automaton:
    """Transition tables compiled from a tokenizer file (a few MB, whatever the corpus).

    ``order[t]``: the token's preorder number; ``target[t]``: the state its arcs lead
    to (``START`` for tokens that end a word); ``bounds[first[s]:first[s + 1]]``: the
    sorted bounds of the intervals of order numbers without an arc from ``s``;
    ``keys`` / ``children`` / ``token_at``: the trie of the tokens' symbols.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        model = conf["model"]
        plain = ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges", "fuse_unk")
        if model["type"] != "BPE" or any(model.get(k) for k in plain) or conf.get("decoder") or conf.get("post_processor"):
            raise ValueError("the automaton compiles plain BPE vocabularies without a decoder")
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        self.labels = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in conf.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in conf.get("added_tokens", [])):
            raise ValueError("special tokens are expected to stand for themselves only")
        self.labels.update({i: t for t, i in self.special.items()})
        merges = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        self._compile([(vocab[u], vocab[v], vocab[u + v]) for u, v in merges], max(self.labels) + 1)
        self._index(vocab)

    def _compile(self, merges: list[tuple[int, int, int]], n: int) -> None:
        if len({w for _, _, w in merges}) != len(merges):
            raise ValueError("two merges make one token")
        size = [1] * n
        for u, _, w in reversed(merges):
            size[u] += size[w]
        later, offset = [0] * n, [0] * n          # sizes of a token's children made after
        for u, _, w in reversed(merges):
            offset[w] = later[u]
            later[u] += size[w]
        made = {w for _, _, w in merges}
        order, at = [0] * n, 0
        for t in range(n):
            if t not in made:
                order[t] = at
                at += size[t]
        for u, _, w in merges:
            order[w] = order[u] + 1 + offset[w]
        self.order = np.array(order, np.int32)

        states, target = [array("i")], [0] * n     # a state: bounds of the intervals it has no arcs in
        done = [0] * n                             # sizes of the children made so far
        self.dead = set()
        for u, v, w in merges:
            q = target[u]
            if u in self.dead or v in self.dead or bisect_right(states[q], order[v]) % 2:
                self.dead.add(w)                   # no arc v after u: the pair never stands there
            else:
                low, high = order[v], order[v] + size[v] - done[v]
                copy = states[q][:]
                copy[(k := bisect_right(copy, low)):k] = array("i", (low, high))
                target[w] = target[v]
                target[u] = len(states)
                states.append(copy)
            done[u] += size[w]
        self.target, self.states = target, states

    def _index(self, vocab: dict[str, int]) -> None:
        symbols, keys, token_at = byte_symbols(), {}, [-1]
        for text, t in vocab.items():
            ends = bool(self.suffix) and text.endswith(self.suffix)
            body = text[:len(text) - len(self.suffix)] if ends else text
            if t in self.dead or not body or any(c not in symbols for c in body):
                continue
            path = [symbols[c] for c in body]
            if ends:
                path[-1] += END
                self.target[t] = START             # nothing follows inside a word
            node = 0
            for s in path:
                key = node << 9 | s
                if key not in keys:
                    keys[key] = len(token_at)
                    token_at.append(-1)
                node = keys[key]
            token_at[node] = t
        used = sorted({s for s in self.target if s != START})
        number = {s: k for k, s in enumerate(used)}
        self.target = np.array([number.get(s, START) for s in self.target], np.int32)
        self.first = np.cumsum([0] + [len(self.states[s]) for s in used])
        self.bounds = np.concatenate([np.asarray(self.states[s], np.int32) for s in used])
        self.keys, self.children = np.array(list(keys), np.int64), np.array(list(keys.values()), np.int32)
        self.token_at = np.array(token_at, np.int32)
        del self.states


class AutomatonEncoder(IdEncoder):
    """Ids of whole texts, words spelt by an :class:`Automaton`."""

    def __init__(self, automaton: Automaton, path: str, cache_size: int = 500_000):
        super().__init__(path, cache_size)
        a = automaton
        self.end = END if a.suffix else 0
        self.goto = dict(zip(a.keys.tolist(), a.children.tolist()))
        self.token_at, self.order, self.target = a.token_at.tolist(), a.order.tolist(), a.target.tolist()
        bounds, first = array("i", a.bounds.tobytes()), a.first.tolist()
        self.bounds = [bounds[i:j] for i, j in zip(first, first[1:])] + [array("i")]     # START is the last
        self.special_ids = a.special
        self.opening = re.compile("|".join(map(re.escape, sorted(a.special, key=len, reverse=True))) or "(?!)")
        names = [a.labels.get(i, "") for i in range(max(a.labels) + 1)]
        self.label = names.__getitem__
        self.byte_of = byte_symbols()
        self.long_words: list[str] = []

    def spell(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word: the automaton's one path that spells it.

        Longer tokens are tried first. At most one path leads to a position, so
        none is expanded twice and the work grows with the word's length."""
        symbols = [*word[:-1], word[-1] + self.end]
        goto, token_at, order, target, bounds = self.goto, self.token_at, self.order, self.target, self.bounds
        n, ids, held, at, gaps = len(symbols), [], [], 0, bounds[START]
        while True:
            ahead, node = [], 0
            for j in range(at, n):
                key = node << 9 | symbols[j]
                if key not in goto:
                    break
                node = goto[key]
                if token_at[node] >= 0:
                    ahead.append((j + 1, token_at[node]))
            while True:
                while not ahead:
                    if not held:
                        raise ValueError("a word holds a byte without a token")
                    ahead, gaps = held.pop()
                    ids.pop()
                at, t = ahead.pop()
                if not bisect_right(gaps, order[t]) & 1:         # the state has this arc
                    break
            ids.append(t)
            if at == n:
                return ids
            held.append((ahead, gaps))
            gaps = bounds[target[t]]

    def _library(self, pieces: list[str]) -> list[bytes]:
        """Ids of single matches of the word pattern."""
        return [np.array(self.spell(p.encode()), "<u4").tobytes() for p in pieces]

    def _whole(self, text: str) -> bytes:
        return self._cut(text)

    def _cut(self, text: str) -> bytes:
        """A text cut at special tokens, then by the library's normaliser and pre-splitter."""
        out, at = [], 0
        for m in [*self.opening.finditer(text), None]:
            part = text[at:m.start() if m else len(text)]
            if part:
                if self.tokenizer.normalizer is not None:
                    part = self.tokenizer.normalizer.normalize_str(part)
                for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    out += self.spell(bytes(map(self.byte_of.__getitem__, piece)))
            if m:
                out.append(self.special_ids[m[0]])
                at = m.end()
        return np.array(out, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        ids = super().encode(text)
        while self.long_words:
            self.cache.pop(self.long_words.pop(), None)
        return ids

    def _learn(self, unseen: list[str]) -> dict[str, bytes]:
        new = super()._learn(unseen)
        self.long_words += [p for p in new if len(p) > KEPT_WORD]
        return new

    def decode(self, ids) -> str:
        """The arcs' labels, as the library joins them."""
        return " ".join(map(self.label, ids))


def tokenised(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids",
              decoded_col: str | None = None) -> DataFrame:
    """``docs`` with ``ids_col`` (``array<int>``) and, if named, ``decoded_col``: those ids decoded again."""
    spark = docs.sparkSession
    tables = spark.sparkContext.broadcast(vars(Automaton(tokenizer)))       # plain numbers, bounded by the vocabulary
    worker = kept_by_worker(spark)
    added = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    if decoded_col:
        added.append(T.StructField(decoded_col, T.StringType()))
    kept = [f for f in docs.schema.fields if f.name not in (ids_col, decoded_col)]
    source = docs.select(*[f.name for f in kept], F.col(text_col).alias("_bpe_text"))

    def run(batches):
        encoder = made_once(worker, "encoder", lambda: AutomatonEncoder(SimpleNamespace(**tables.value), tokenizer))
        for batch in batches:
            rows = [np.frombuffer(encoder.encode(t.as_py()), "<u4").astype(np.int32) for t in batch.column(len(kept))]
            ends = np.cumsum([0] + [len(r) for r in rows])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows) if rows else [], pa.int32()))
            columns = [*batch.columns[:len(kept)], ids]
            if decoded_col:
                columns.append(pa.array([encoder.decode(r.tolist()) for r in rows], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in kept + added])

    return source.mapInArrow(run, T.StructType(kept + added))


def detokenised(rows: DataFrame, tokenizer: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``rows`` with ``decoded_col``: the text their ids decode to (null ids: empty)."""
    tables = rows.sparkSession.sparkContext.broadcast(Automaton(tokenizer).labels)
    kept = [f for f in rows.schema.fields if f.name != decoded_col]
    at = [f.name for f in kept].index(ids_col)

    def run(batches):
        label = tables.value.__getitem__
        for batch in batches:
            texts = [" ".join(map(label, ids.as_py() or ())) for ids in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [f.name for f in kept] + [decoded_col])

    return rows.select(*[f.name for f in kept]).mapInArrow(run, T.StructType(kept + [T.StructField(decoded_col, T.StringType())]))
