"""The registered queries with SQL against DuckDB, and the pipeline against brute force."""

import os
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as ENTRY  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import duck, value_hash  # noqa: E402
from snapreel.llm import toxicity  # noqa: E402
from snapreel.llm.common import table  # noqa: E402
from snapreel.llm.oracle import ORACLE_SQL  # noqa: E402
from snapreel.llm.queries import QUERIES  # noqa: E402
from test_operators import LOWER, linked  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = ENTRY.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SF).execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert value_hash(rows, df.columns) == value_hash(cur.fetchall(), columns)


def test_every_operator_and_the_pipeline_are_registered():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(ENTRY.queries())
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def words(pattern, text):
    return [w for w in re.split(pattern, text.translate(LOWER)) if w]


def without_repeated_lines(docs):
    """Cut lines with an earlier line of Jaccard similarity 0.8 or more; drop documents left without words."""
    seen, out = [], []
    for i, text in sorted(docs):
        kept, cut = [], 0
        for line in text.split("\n"):
            t = frozenset(words(r"[\x20\x09-\x0D]+", line))
            gone = bool(t) and any(100 * len(t & s) >= 80 * len(t | s) for s in seen)
            if t:
                seen.append(t)
            cut += gone
            if not gone:
                kept.append(line)
        left = "\n".join(kept)
        if not cut or words(r"[\x20\x09-\x0D]+", left):
            out.append((i, left))
    return out


def one_of_each_group(docs):
    sets, group = linked(docs, 5)
    first = {}
    for (i, _), g, s in zip(docs, group, sets):
        if s:
            first[g] = min(i, first.get(g, i))
    return [d for d, g, s in zip(docs, group, sets) if not s or first[g] == d[0]]


def without_items(docs, items):
    pattern = "[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    grams = set()
    for t in items:
        v = words(pattern, t)
        n = min(10, len(v))
        grams |= {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if v else set()
    sizes = {len(g) for g in grams}
    out = []
    for i, text in docs:
        w = words(pattern, text)
        if not any(tuple(w[k:k + n]) in grams for n in sizes for k in range(len(w) - n + 1)):
            out.append((i, text))
    return out


def test_pipeline_equals_brute_force(spark):
    documents = table(spark, SF, "documents")
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    slope_level = toxicity.train(documents, table(spark, SF, "labels"))
    scorer = toxicity.Scorer(slope_level[0], slope_level[1])
    slope, level = slope_level[2]
    docs = [d for d in docs if 1 / (1 + np.exp(-(slope * scorer.score(d[1]) + level))) < corpus_pipeline.TOXIC]
    docs = without_repeated_lines(docs)
    docs = one_of_each_group(docs)
    docs = without_items(docs, [r.text for r in table(spark, SF, "benchmark").collect()])
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, text in docs:
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            want.add((i, k, at, len(ids[at:at + 2048]), zlib.crc32(np.array(ids[at:at + 2048], "<u4").tobytes())))
    got = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)


def test_pipeline_stages_keep_columns_and_take_empty_tables(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        if name != "packing":
            assert out.columns == docs.columns
