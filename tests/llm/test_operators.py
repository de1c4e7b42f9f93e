"""Every operator against brute force on a small table that holds the awkward cases."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapreel.llm import ann, decontam, labelled, linedup, neardup, packing, pii, quality, shards, tokenfile, toxicity
from snapreel.session import scratch_path

KEY = b"a test's key"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, score double, start string, mark int"
WORDS = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi", "omicron"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


def corpus():
    rng = random.Random(4)
    base = [prose(rng, 60) for _ in range(6)]
    texts = [None, "", " \n ", "one", "one", "two words", prose(rng, 3), *base, base[0], base[0]]
    for b in base[:3]:                                   # near copies
        for k in (2, 5, 14):
            words = b.split()
            for _ in range(k):
                words[rng.randrange(60)] = "new" + str(rng.randrange(999))
            texts.append(" ".join(words))
    line = prose(rng, 12)
    texts += [f"{prose(rng, 20)}\n{line}\n{prose(rng, 9)}", f"{line}\n{prose(rng, 30)}", f"{line} extra\n{prose(rng, 7)}\n{line}"]
    texts += [prose(rng, 4000), "\n".join([prose(rng, 40)] * 3), "mail a.b@c.example.org now", "tab\tand\x0bvt\rcr word"]
    rows = [(k + 10, t, "en", "src" + str(k % 3) if k % 7 else None, 0, k, 0.5, "s", 1) for k, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, base[4], "en", "src1", 0, 0, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def text_of(row):
    return row[1] or ""


def test_token_files(spark, docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    out = scratch_path(spark, "t")
    tokenfile.write_ids(docs, path, out, block_ids=500)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32, r.ids) for r in tokenfile.read_ids(spark, out, with_ids=True).collect()))
    assert [g[1] for g in got if g[1] is not None] == sorted(r[0] for r in corpus() if r[0] is not None)
    assert all(g[1] is None for g in got[:2]) and len(got) == len(corpus())
    want = sorted((str(r[0]), library.encode(text_of(r), add_special_tokens=False).ids + [0]) for r in corpus())
    assert sorted((str(g[1]), g[4]) for g in got) == want
    end = 0
    for start, _, n, crc, ids in got:
        assert start == end and n == len(ids) and crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        end += n
    empty = scratch_path(spark, "t")
    tokenfile.write_ids(none, path, empty)
    assert tokenfile.read_ids(spark, empty).count() == 0


def shingles(text, n):
    w = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def linked(rows, n):
    sets = [shingles(r[1], n) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    return sets, group


def test_near_duplicates(spark, docs, none):
    rows = corpus()
    sets, group = linked(rows, 4)
    want = []
    for k, r in enumerate(rows):
        ids = [x[0] for x, g in zip(rows, group) if g == group[k] and x[0] is not None] if sets[k] else [r[0]]
        low = min(ids) if ids and ids[0] is not None else None
        want.append((str(r[0]), len(sets[k]), str(low), r[0] == low))
    got = [(str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in neardup.groups(docs, words=4).collect()]
    assert sorted(got) == sorted(want)
    kept = neardup.deduplicate(docs, words=4)
    assert kept.columns == docs.columns
    left = [shingles(r.text, 4) for r in kept.collect()]
    assert len([s for s in left if s]) == len({g for g, s in zip(group, sets) if s}) and sum(not s for s in left) == sum(not s for s in sets)
    assert neardup.groups(none).count() == 0 and neardup.deduplicate(none).count() == 0


def test_near_duplicates_of_a_large_group_in_chunks(spark, monkeypatch):
    """A group cut into many chunks and both rounds gives the same components as brute force."""
    monkeypatch.setattr(neardup, "CHUNK_ROWS", 7)
    rng = random.Random(8)
    base, rows = prose(rng, 80).split(), []
    for k in range(60):
        words = list(base)
        for _ in range(rng.choice([1, 3, 6, 9])):
            words[rng.randrange(80)] = "x" + str(rng.randrange(9999))
        rows.append((k, " ".join(words)))
    sets, group = linked(rows, 5)
    got = {r.doc_id: r.component_id for r in neardup.groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {k: min(j for j in range(60) if group[j] == group[k]) for k in range(60)}


def test_pii(spark, docs, none):
    out = pii.pseudonymise(docs, KEY)
    assert out.columns == [*docs.columns, "_pii_found"]
    rows = out.collect()
    assert len(rows) == len(corpus()) and not any("a.b@c.example.org" in (r.text or "") for r in rows)
    assert sum(r._pii_found for r in rows) == 1
    plain = sorted(str(r.text) for r in rows if not r._pii_found)
    assert plain == sorted(str(r[1]) for r in corpus() if "@" not in text_of(r))
    assert pii.pseudonymise(none, KEY).count() == 0
    many = spark.createDataFrame([(k, f"u{k % 40}@ex.com and 10.0.{k % 7}.1") for k in range(80)], "doc_id bigint, text string")
    found = pii.entities(many, KEY).collect()
    assert len(found) == 47 and len({(r.kind, r.surrogate) for r in found}) == 47
    assert not {r.surrogate for r in found} & {r.form for r in found}


def test_pii_collisions_are_resolved(spark):
    """Numbers of two digits in a name-like format: permutations hit other originals, and tweaks part them."""
    rows = [(k, f"Mr. {a}{b}") for k, (a, b) in enumerate((a, b) for a in "BCD" for b in "aeiou")]
    rows = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = pii.entities(rows, KEY).collect()
    assert len({r.surrogate for r in found}) == len(found) and not {r.surrogate for r in found} & {r.form for r in found}
    out = pii.pseudonymise(rows, KEY).collect()
    assert sorted(r.text for r in out) == sorted("Mr. " + r.surrogate for r in found)


def test_pii_formats_that_the_corpus_uses_up(spark):
    """All surnames of a consonant and a vowel are originals; matches without a symbol to replace are no entities."""
    texts = [f"Mary {a}{b} came." for a in "BCDFGHJKLMNPQRSTVWXYZ" for b in "aeiou"] + ["--@--.-- and _@-.com", "Dr. Ñå left, password: ========"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = pii.entities(rows, KEY).collect()
    assert len(found) == 107 and len({(r.kind, r.surrogate) for r in found}) == 107
    assert not {(r.kind, r.surrogate) for r in found if r.kind.startswith("surname")} & {(r.kind, r.form) for r in found}
    assert all(r.surrogate != r.form for r in found)
    out = {r.doc_id: r for r in pii.pseudonymise(rows, KEY).collect()}
    assert out[105].text == texts[105] and out[105]._pii_found == 0 and "Ñå" not in out[106].text
    assert len({r.text for r in out.values()}) == 107


def test_line_dedup(spark, docs, none):
    def tokens(line):
        return frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.translate(LOWER)) if w)
    unique = {}
    for r in corpus():
        unique.setdefault((r[0], r[1]), r)
    order = sorted(unique.values(), key=lambda r: (r[0] is None, r[0] or 0, 0 if r[1] is None else 1))
    seen, want = [], {}
    for r in order:
        kept = []
        for line in text_of(r).split("\n"):
            t = tokens(line)
            if t and any(100 * len(t & s) >= 80 * len(t | s) for s in seen):
                seen.append(t)
                continue
            if t:
                seen.append(t)
            kept.append(line)
        want[(r[0], r[1])] = None if r[1] is None else "\n".join(kept)
    out = linedup.deduplicate_lines(docs)
    assert sorted(str((r.doc_id, r.text)) for r in out.collect()) == sorted(str((r[0], want[(r[0], r[1])])) for r in corpus())
    cut = linedup.cut_lines(docs)
    assert cut.columns == docs.columns and cut.count() < docs.count()
    assert linedup.cut_lines(none).count() == 0


def test_line_tokens_are_computed_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b  c a\n\n\td e"), (2, "f\u00c4 g"), (3, None)], "doc_id bigint, text string")
    stored = []

    def first(df, name):
        stored.append(df)
        raise StopIteration
    monkeypatch.setattr(linedup, "staged", first)
    with pytest.raises(StopIteration):
        linedup.removed_lines(docs)
    assert stored[0]._jdf.queryExecution().optimizedPlan().toString().count("array_remove(") == 1
    tokens = linedup._tokens(F.col("text"), list(range(1 << linedup.RANK_BITS)))
    assert not docs.select(tokens.alias("t")).schema["t"].dataType.containsNull        # plain numbers are sorted
    assert [r.n for r in stored[0].orderBy("doc_id", "line").select("n").collect()] == [3, 2, 2]


def test_line_ranks_are_one_constant(spark):
    """The driver's plan of the tokens does not grow by a node for each rank."""
    tokens = linedup._tokens(F.lit("b a"), list(range(1 << linedup.RANK_BITS)))
    assert not re.search(r"\barray\(", spark.range(1).select(tokens)._jdf.queryExecution().analyzed().toString())


def test_long_similar_lines_and_dropped_tables(spark, monkeypatch):
    """Similar lines of 100 to 268 words; tables of no further use are gone."""
    stored, stage = {}, linedup.staged
    monkeypatch.setattr(linedup, "staged", lambda df, name: stored.setdefault(name, stage(df, name)))
    words = [f"w{k}" for k in range(300)]
    n = 100
    texts = [" ".join(words[:n]), " ".join(words[:n + 20]), " ".join(words[5:n + 15]), " ".join(words[40:n + 40]), " ".join(words[40:n + 61]),
             " ".join(words[:260]), " ".join(words[30:290]), " ".join(words[32:300])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    seen, want = [], []
    for text in texts:
        t = set(text.split())
        want.append("" if any(100 * len(t & s) >= 80 * len(t | s) for s in seen) else text)
        seen.append(t)
    gone = linedup.removed_lines(docs)
    assert {r.doc_id for r in gone.collect()} == {k for k, w in enumerate(want) if not w} and "" in want[:3] and "" in want[5:]
    for name in ("lines", "line-classes", "line-meetings", "line-tokens"):
        assert not os.path.exists(os.path.dirname(stored[name]._jdf.inputFiles()[0].removeprefix("file://")) + "/_SUCCESS"), name


def test_short_lines_and_hot_classes(spark, monkeypatch):
    """Lines of one to five words, unspaced ones, and a class of more lines than one task gathers."""
    monkeypatch.setattr(linedup, "HOT_LINES", 3)
    texts = ["All rights reserved.\nfirst own line", "x y z\nAll rights reserved.", "all RIGHTS reserved.\n全部の権利は保護されています", "全部の権利は保護されています\na b c d",
             "a b c d e\nALL rights reserved. reserved.", "a b c\na b d c", "\n  \nx y", "one\none\ntwo", "rights reserved. all"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    seen, want = [], []
    for text in texts:
        kept = []
        for line in text.split("\n"):
            t = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.translate(LOWER)) if w)
            if not (t and any(100 * len(t & s) >= 80 * len(t | s) for s in seen)):
                kept.append(line)
            if t:
                seen.append(t)
        want.append("\n".join(kept))
    out = {r.doc_id: r for r in linedup.deduplicate_lines(docs).collect()}
    assert [out[k].text for k in range(len(texts))] == want
    assert out[1].text == "x y z" and out[4].text == "" and out[8].text == ""
    assert linedup.deduplicate_lines(docs, min_tokens=4).where("doc_id = 7").first().text == texts[7]


def test_decontamination(spark, docs, none):
    rows = corpus()
    items = [(1, " ".join(text_of(rows[8]).split()[5:40])), (2, "two words"), (3, None), (4, "!!"), (5, "not here at all " * 5), (2, "two words"),
             (6, " ".join(text_of(rows[9]).split()[:9])), (None, "one"), (7, " ".join(text_of(rows[10]).split()[50:]) + " tail")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")

    def words(t):
        return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER)) if w]
    want = []
    for r in rows:
        w, hit, met = words(r[1]), set(), set()
        for i, t in items:
            v = words(t)
            n = min(10, len(v))
            grams = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if v else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    met.add("" if i is None else str(i))
        want.append((str(r[0]), len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    got = decontam.contamination(docs, bench).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(want)
    clean = decontam.clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not w[5] for w in want)
    assert decontam.contamination(none, bench).count() == 0
    assert decontam.contamination(docs, bench.limit(0)).where("contaminated").count() == 0


def test_decontamination_without_broadcast(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(1, " ".join(text_of(corpus()[8]).split()[5:40]))], "item_id bigint, text string")
    want = sorted(map(str, decontam.contamination(docs, bench).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        out = decontam.contamination(docs, bench)
        assert sorted(map(str, out.collect())) == want
        found = decontam.hits(decontam._keyed(docs, "doc_id", "text"), bench, ["doc_id", "text_key"])
        plan = found._jdf.queryExecution().executedPlan()
        for line in plan.treeString().splitlines():        # what a join's exchange carries: no array of a document's length
            if "Exchange hashpartitioning(length" in line:
                assert "h#" not in line.split("]", 1)[0] and " g#" not in line
        names = decontam._winnowed(decontam._keyed(docs, "doc_id", "text"), ["doc_id"]).columns
        assert "h" in names                                # the frame before the projection has it
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_shards(spark, docs, none):
    out = shards.interleave(docs, n_shards=4, piece_rows=5).collect()
    assert len(out) == len(corpus())
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == sorted(
        (str(r[0]), len(text_of(r).encode()) + 16, zlib.crc32(text_of(r).encode())) for r in corpus())
    slots = {s: sorted(r.slot for r in out if r.shard == s) for s in range(4)}
    sizes = [len(v) for v in slots.values()]
    assert all(v == list(range(len(v))) for v in slots.values()) and max(sizes) - min(sizes) <= 1
    for source in {r[3] for r in corpus()}:
        share = [sum(r.source == source for r in out if r.shard == s) for s in range(4)]
        assert max(share) - min(share) <= 2
    assert shards.interleave(none).count() == 0


def test_shards_of_single_row_sources_and_repeated_rows(spark, monkeypatch):
    """Equal shares and equal rows are dealt to many pieces: none holds more than a few times its part."""
    rows = [(k, f"t{k}", f"host{k}") for k in range(4000)] + [(7, "same", "big")] * 4000
    docs, pieces = spark.createDataFrame(rows, "doc_id bigint, text string, source string"), []
    real = shards.rank_in_buckets
    monkeypatch.setattr(shards, "rank_in_buckets", lambda f, *a, **k: (pieces.append(f.groupBy("piece").count().agg(F.max("count")).first()[0]), real(f, *a, **k))[1])
    out = shards.interleave(docs, n_shards=8, piece_rows=400).collect()
    assert max(pieces) <= 1200 and len(out) == 8000
    assert sorted((r.shard, r.slot) for r in out) == [(s, k) for s in range(8) for k in range(1000)]


def test_packing(spark, docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    out = packing.pack(docs, path, max_len=128).collect()
    want = []
    for r in corpus():
        ids = library.encode(text_of(r), add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 128)):
            part = ids[at:at + 128]
            want.append((str(r[0]), k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    spots = {}
    for r in out:
        spots.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in spots.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        assert end <= 128
    assert len(spots) <= 1.1 * sum(w[3] for w in want) / 128 + 1
    assert packing.pack(none, path).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 12)).astype(np.float32)
    x[300:340] = x[300]                                   # equal vectors
    rows = [(k, [float(v) for v in x[k]]) for k in range(900)]
    rows += [(900, None), (901, [0.0] * 12), (902, [float("nan")] * 12), (903, [None] * 12), (904, [1.0] * 5), (None, [1.0] * 12), (905, [])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("clash"))
    out = {}
    for r in ann.neighbours(table, k=10, every=50, piece_rows=100).collect():
        out.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    x = x.astype(float)
    hits = total = 0
    assert sorted(out) == list(range(0, 900, 50))
    for q, found in out.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        best = [k for k in np.lexsort((np.arange(900), d)) if k != q][:10]
        assert sorted(found) == list(range(1, 11))
        ranked = [found[k] for k in range(1, 11)]
        assert ranked == sorted(ranked) and all(s == pytest.approx(d[i], abs=1e-12) for s, i in ranked)
        hits += len(set(best) & {i for _, i in ranked})
        total += 10
    assert hits / total >= 0.9
    assert [i for _, i in sorted(out[300].values())] == list(range(301, 311))      # ties by id
    assert ann.neighbours(table.limit(0)).count() == 0
    assert ann.neighbours(spark.createDataFrame(rows[:4], "vec_id bigint, embedding array<float>"), every=2).count() == 6


def test_neighbours_in_double_precision(spark):
    """Vectors that are equal in single precision are told apart, and scores are those of the doubles."""
    x = [[1.0 + k * 1e-12, 2.0, 3.0, 4.0] for k in range(30)]
    found = ann.neighbours(spark.createDataFrame(list(enumerate(x)), "vec_id bigint, embedding array<double>"), k=5, every=30).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank)] == [1, 2, 3, 4, 5]
    assert all(r.score == abs(x[r.vec_id][0] - x[0][0]) for r in found)


def test_neighbours_of_repeated_queries(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 12)).astype(np.float32)
    rows = [(k, [float(v) for v in x[k]]) for k in range(60)]
    rows += [rows[0], (50, [float(v) for v in x[7]])]                 # a row twice, and an id with another vector
    found = ann.neighbours(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), k=10, every=50).collect()
    x = x.astype(float)

    def nearest(v, own):
        d = np.sqrt(((np.array([r[1] for r in rows]) - v) ** 2).sum(axis=1))
        return [(rank + 1, rows[k][0]) for rank, k in enumerate([k for k in np.lexsort(([r[0] for r in rows], d)) if rows[k][0] != own][:10])]
    assert sorted((r.rank, r.vec_id) for r in found if r.query_id == 0) == nearest(x[0], 0)
    assert sorted((r.rank, r.vec_id) for r in found if r.query_id == 50) == sorted(nearest(x[50], 50) + nearest(x[7], 50))


def labels_for(spark, rows):
    return spark.createDataFrame([(r[0], int(k % 2 == 0), int(k % 3 == 0)) for k, r in enumerate(rows) if r[0] is not None],
                                 "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("operator,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_handle_any_rows(spark, docs, none, operator, label):
    labels = labels_for(spark, corpus())
    for known in (labels, labels.limit(0), labels.where(F.col(label) == 1)):
        model = operator.train(docs, known, label)
        out = operator.scored(docs, model, out="p")
        scores = [r.p for r in out.collect()]
        assert out.columns == [*docs.columns, "p"] and len(scores) == len(corpus()) and all(0 <= s <= 1 for s in scores)
        by_text = {}
        for r in out.collect():
            assert by_text.setdefault(r.text, r.p) == r.p                      # repeated rows score alike
    assert operator.scored(none, operator.train(none, labels, label)).count() == 0


def test_held_out_rows_are_never_fitted(spark, docs):
    got = {r.doc_id: r.h for r in docs.select("doc_id", labelled.held_out().alias("h")).collect()}
    assert got == {r[0]: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in corpus()}
    rows, counts = labelled.sample(docs, labels_for(spark, corpus()), "toxic")
    fitted = {r.text for r in rows.collect()}
    free = {r[1] for r in corpus() if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1}
    assert fitted <= free and sum(counts.values()) <= len(corpus())


def auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    n1 = int(label.sum())
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


@pytest.mark.parametrize("operator,label,floor", [(toxicity, "toxic", 0.9), (quality, "quality", 0.98)])
def test_held_out_accuracy(spark, operator, label, floor):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = operator.train(docs, labels, label)
    judged = operator.scored(docs.join(labels, "doc_id").where(labelled.held_out()).select("doc_id", "text", label), model)
    rows = judged.select("score", label).collect()
    assert auc(np.array([r.score for r in rows]), np.array([r[label] for r in rows])) > floor
