"""Token ids of whole texts by the ``tokenizers`` library, with a bounded piece cache.

A byte-level or word-level BPE first cuts a text into pieces and then encodes
each piece on its own, so a piece's ids never depend on its neighbours. Pieces
never cross white space but for the one space that a byte-level piece may
start with, so the encoder splits a text at white space (by the pattern, where
spaces stand together), looks every part up in a cache and sends only unseen
parts to the library. This is done for texts
whose characters all lie in a range where the pattern can have one reading
only (ASCII, Latin-1 and Latin Extended letters); any other text, and any text
that holds the opening of a special token, goes to the library whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# Characters on which both pattern engines agree, and their letters.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
PLAIN = re.compile("[\t\n\r\x20-\x7e¡-©«-±´¶-¸»¿-įı-ɏ]*")
EXACT = "\x00"           # marks a piece that no space stands before (never in a plain text)
JOINED = 1000            # new pieces that are encoded as one text
SPACE = "\u0120"         # how byte-level vocabularies write a space
ONE_SPACE = re.compile(r" \S+")
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_PIECES = re.compile(rf"{CONTRACTIONS}| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
WORD_PIECES = re.compile(rf"{CONTRACTIONS}|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")


class IdEncoder:
    """``encode(text) -> bytes`` of little-endian unsigned 32-bit ids.

    ``cache_size`` bounds the cached parts; a full cache becomes the older one,
    from which parts still in use come back, and the one before it is dropped. ``special`` strings occurring in a
    text keep the library's treatment.
    """

    def __init__(self, path: str, cache_size: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        self.special = [t["content"] for t in conf.get("added_tokens", [])]
        kind = (conf.get("pre_tokenizer") or {}).get("type")
        self.lower = conf.get("normalizer") is not None
        self.pieces = {("ByteLevel", False): BYTE_PIECES, ("Sequence", True): WORD_PIECES}.get((kind, self.lower))
        suffix = conf["model"].get("end_of_word_suffix")
        self.marks = None                     # which ids end a word (lower-case vocabularies) or start one (byte-level ones)
        if self.pieces is not None and (suffix or not self.lower):
            vocabulary = self.tokenizer.get_vocab()
            self.marks = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.marks[[i for t, i in vocabulary.items() if (t.endswith(suffix) if self.lower else t.startswith(SPACE))]] = True
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cache_size = cache_size

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def _whole(self, text: str) -> bytes:
        """Ids of a text that is not cut here."""
        return self._encoded([text])[0]

    def _library(self, pieces: list[str]) -> list[bytes]:
        """Ids of single pieces. Where a vocabulary marks the ends or the starts of words, many pieces
        are encoded as one text of words, whose ids are cut at the marks again."""
        if self.marks is None:
            return self._encoded(pieces)
        known: dict[str, bytes] = {}
        # a piece of a byte-level vocabulary is a word of such a text if it starts with the one space in it
        words = pieces if self.lower else [p for p in pieces if ONE_SPACE.fullmatch(p)]
        for at in range(0, len(words), JOINED):
            part = words[at:at + JOINED]
            raw = self._whole((" " if self.lower else "").join(part))
            cuts = ((np.flatnonzero(self.marks[np.frombuffer(raw, "<u4")]) + self.lower) * 4).tolist()
            if len(cuts) == len(part):
                edges = [0, *cuts] if self.lower else [*cuts, len(raw)]
                known.update((p, raw[a:b]) for p, a, b in zip(part, edges, edges[1:]))
        rest = [p for p in pieces if p not in known]
        known.update(zip(rest, self._encoded(rest)))
        return [known[p] for p in pieces]

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text; a null or empty text has none."""
        if not text:
            return b""
        if (self.pieces is None or not PLAIN.fullmatch(text)
                or any(s in text for s in self.special)):
            return self._whole(text)
        if self.lower:
            pieces = text.lower().split()            # no match of the pattern holds white space
        elif "  " not in text:
            # a single space always starts a piece: keys stand for a space and themselves
            pieces = text.split(" ")
            pieces[0] = EXACT + pieces[0]
        else:
            pieces = [EXACT + p for p in self.pieces.findall(text)]
        get = self.cache.get
        out = list(map(get, pieces))
        if None in out:
            unseen = list({p for p, ids in zip(pieces, out) if ids is None})
            new = {p: self.older[p] for p in unseen if p in self.older}
            new.update(self._learn([p for p in unseen if p not in new]))
            if len(self.cache) + len(new) > self.cache_size:
                self.older, self.cache = self.cache, {}
            self.cache.update(new)
            out = [ids if ids is not None else new[p] for p, ids in zip(pieces, out)]
        return b"".join(out)

    def _learn(self, unseen: list[str]) -> dict[str, bytes]:
        """Ids of unseen parts, put together from the pattern's pieces; pieces are cached too."""
        cut = [self.pieces.findall(self._text(p)) for p in unseen]
        known = {}
        for p in {p for c in cut for p in c}:
            key = self._key(p)
            ids = self.cache.get(key)
            known[p] = self.older.get(key) if ids is None else ids
        missing = [p for p, ids in known.items() if ids is None]
        known.update(zip(missing, self._library(missing)))
        new = {self._key(p): known[p] for p in missing}
        new.update((p, b"".join(map(known.__getitem__, c))) for p, c in zip(unseen, cut))
        return new

    def _key(self, piece: str) -> str:
        """The key of a piece of the pattern: the opposite of :meth:`_text`."""
        if self.lower:
            return piece
        return piece[1:] if len(piece) > 1 and piece[0] == " " else EXACT + piece

    def _text(self, piece: str) -> str:
        """The text a cached piece stands for."""
        if self.lower:
            return piece
        return piece[1:] if piece.startswith(EXACT) else " " + piece
