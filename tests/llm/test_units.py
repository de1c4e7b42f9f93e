"""The operators' pure parts: codec, token pieces, packing plan, permutations, kernels, trees."""

import bisect
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snapreel.llm import ann, labelled, packing, pii, quality, rangecoder, toxicity
from snapreel.llm.tokens import IdEncoder


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000)), max_size=3000))
def test_range_coder_round_trip(ids):
    x = np.array(ids, dtype="<u4")
    assert (rangecoder.decode(rangecoder.encode(x)) == x).all()


@pytest.mark.parametrize("n", [0, 1, 511, 512, 5000, 40_000])
def test_range_coder_lengths_and_compression(n):
    x = np.random.default_rng(n).zipf(1.3, n).clip(0, 50000).astype("<u4")
    block = rangecoder.encode(x, 50257)
    assert (rangecoder.decode(block) == x).all()
    if n > 10_000:
        assert len(block) < 2 * n


def test_damaged_block_is_refused():
    block = bytearray(rangecoder.encode(np.arange(2000, dtype="<u4")))
    for at in (0, 40, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            rangecoder.decode(bytes(bad))


TRICKY = ["", " ", "  ", "\n", "a\n\n b", "it's 'll 's", "a  b   c\t d", "x y", "ÀÉ ñandú straße İ", "日本語 текст", "<|endoftext|> a",
          "12345 1,234.5", "a_b__c", "́e é", "word$$$ ###", "'s's", " \n \n x ", "ſt \x1c\x1d!"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_piece_cache_gives_the_library_ids(name):
    path = public_tokenizers.path(name)
    encoder, library = IdEncoder(path, cache_size=40), Tokenizer.from_file(path)
    rng = random.Random(1)
    texts = TRICKY + ["".join(rng.choice("ab 'sé1\n\t.,$Z  ") for _ in range(rng.randrange(200))) for _ in range(300)]
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    assert encoder.encode(None) == b""


def best_fit_count(lengths, max_len):
    rooms, opened = [], 0
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, n)
        room = rooms.pop(i) if i < len(rooms) else max_len
        opened += room == max_len
        if room > n:
            bisect.insort(rooms, room - n)
    return opened


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=120))
def test_packing_plan_is_best_fit_decreasing(lengths):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.best_fit_plan(histogram, 32)
    places, ranks = {}, {}
    for n, first, last, sequence, offset in plan:
        for r in range(first, last):
            ranks.setdefault(n, []).append(r)
            places.setdefault(sequence + r - first, []).append((offset, n))
    assert all(sorted(r) == list(range(histogram[n])) for n, r in ranks.items()) and set(ranks) == set(histogram)
    for spots in places.values():
        end = 0
        for offset, n in sorted(spots):
            assert offset == end
            end += n
        assert end <= 32
    assert len(places) == best_fit_count(lengths, 32)


@pytest.mark.parametrize("histogram,max_len", [({11: 2, 4: 2, 3: 3}, 20), ({23: 2, 4: 2, 3: 3}, 32), ({1117: 300, 302: 289, 230: 863}, 2048)])
def test_packing_plan_fills_a_sequence_before_the_next_of_its_run(histogram, max_len):
    plan = packing.best_fit_plan(histogram, max_len)
    places = {}
    for n, first, last, sequence, offset in plan:
        for r in range(first, last):
            places.setdefault(sequence + r - first, []).append((offset, n))
    assert {n: sum(m == n for s in places.values() for _, m in s) for n in histogram} == histogram
    for spots in places.values():
        assert [o for o, _ in sorted(spots)] == [sum(n for _, n in sorted(spots)[:k]) for k in range(len(spots))]
    assert len(places) == best_fit_count([n for n, c in histogram.items() for _ in range(c)], max_len)


def test_permutation_is_one_to_one():
    seen = {tuple(pii.permute([(a, 10), (b, 26), (c, 3)], b"k", "t")) for a in range(10) for b in range(26) for c in range(3)}
    assert len(seen) == 780
    names = pii.GIVEN["f.latin"]
    new = [pii.surrogate("given.f.latin", n, 0, b"k") for n in names]
    assert sorted(new) == sorted(names) and all(a != b for a, b in zip(names, new))


def test_mentions_and_formats():
    text = ("Mail the.72@mail3.example.com or THE.72@MAIL3.EXAMPLE.COM, call +1 (974) 555-3436 or +1 974 555 3436; card "
            "4111 1111 1111 1111; ip 169.122.221.182; token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" ssn 123-45-6789. "
            "Mrs. Mary Smith met John Miller. Smith left. Иван Петров came.")
    found = {}
    for a, b, kind, form in pii.find(text):
        found.setdefault((kind, form), []).append(pii.render(text[a:b], kind, pii.surrogate(kind, form, 0, b"k")))
    assert len(found[("email", "the.72@mail3.example.com")]) == 2
    low, up = found[("email", "the.72@mail3.example.com")]
    assert low.upper() == up and low.endswith(".com")
    one, two = found[("phone", "+1|9745553436")]
    assert [c for c in one if c.isdigit()] == [c for c in two if c.isdigit()] and one[2:4] == " ("
    card = found[("card", "4111111111111111")][0]
    assert pii.luhn(card.replace(" ", "")) and len(card) == 19
    assert found[("given.f.latin", "Mary")][0] in pii.GIVEN["f.latin"]
    assert len(found[("surname.latin", "Smith")]) == 2 and len(set(found[("surname.latin", "Smith")])) == 1
    assert found[("given.m.cyrillic", "Иван")][0] in pii.GIVEN["m.cyrillic"]


def test_secrets_are_found_in_texts_without_digits():
    for text in ("password: correcthorsebattery", "password: correcthorsebattery and 7"):
        assert [m[2:] for m in pii.find(text)] == [("secret", "correcthorsebattery")]


def test_kernel_table_equals_the_kernel():
    """A margin from letter triples equals the sum over landmarks of weight times kernel."""
    chunks = [toxicity.windows(toxicity.fold(w))[0] for w in ("idiot", "idiiot", "table", "trash")]
    unit = toxicity._unit(chunks)
    alpha = np.array([1.0, -0.5, 0.25, 2.0])
    table = alpha @ unit
    want = (unit @ unit.T) @ alpha + 0.1
    assert np.allclose(toxicity.margins(chunks, table, 0.1), want, atol=1e-5)
    k = unit @ unit.T
    assert k[0, 1] > 0.5 > k[0, 2]


def test_fit_reads_its_whole_sample_in_little_memory():
    """The bounds are not cut to save memory: the fit holds no rows over all triples and no copy of all rows."""
    assert labelled.PER_CLASS == 2500 and (toxicity.LANDMARKS, toxicity.NEGATIVES) == (96, 30_000)
    rng = random.Random(3)
    words = sorted({toxicity.windows(bytes(rng.randrange(1, 27) for _ in range(8)))[0] for _ in range(3000)})
    rng.shuffle(words)
    bad, good = words[:90], words[90:]
    docs = [[*rng.sample(good, 30), bad[k // 4]] for k in range(360)] + [rng.sample(good, 30) for _ in range(600)]
    tracemalloc.start()
    toxicity.fit(docs, np.array([1] * 360 + [0] * 600), {0: 600, 1: 360})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    codes = toxicity._codes(bad)
    parts = np.concatenate([k for _, k in toxicity._kernel(good, toxicity._unit(bad, codes), codes)])
    assert np.allclose(parts, toxicity._unit(good) @ toxicity._unit(bad).T, atol=1e-5)


def test_scorer_joins_lone_letters_and_reads_whole_texts():
    bad = toxicity.windows(toxicity.fold("idiot"))
    table = toxicity._unit(bad)[0].astype(float)
    scorer = toxicity.Scorer(table, 0.0, cache_size=50)
    assert scorer.score("the i d i o t here") == pytest.approx(1, abs=1e-5)
    assert scorer.score("x" * 3000 + " i-d-i-o-t") == pytest.approx(1, abs=1e-5)
    assert scorer.score(" ".join(f"w{k}" for k in range(300)) + " idiot") == pytest.approx(1, abs=1e-5)
    assert scorer.score(None) == scorer.score("") == toxicity.NO_CHUNK


@pytest.mark.parametrize("gapped", ["i - d - i - o - t", "i * d * i * o * t", "id iot", "i diot", "idi ot", "i di ot", "id -- iot"])
def test_gapped_words_are_chunks(gapped):
    bad = toxicity.windows(toxicity.fold("idiot"))
    if len(gapped) > 12:
        assert bad[0] in toxicity.chunks_of(f"whatever {gapped} somebody")
    scorer = toxicity.Scorer(toxicity._unit(bad)[0].astype(float), 0.0, cache_size=50)
    assert scorer.score(f"whatever {gapped} somebody") == pytest.approx(1, abs=1e-5)
    assert scorer.score(f"{gapped} " + " ".join(f"ab{k}c" for k in range(300))) == pytest.approx(1, abs=1e-5)


def test_factorisation_machine_identity():
    rng = np.random.default_rng(0)
    model = (0.3, rng.normal(size=quality.FEATURES), rng.normal(size=(quality.FEATURES, quality.FACTORS)),
             np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))
    at, values, stats = quality.Reader().features("some words and some more words\nand a line ###")
    index = np.concatenate([at, np.arange(1 << quality.WORD_BITS, quality.FEATURES)])
    x = np.concatenate([values, np.clip(stats, -4, 4)])
    v = model[2][index]
    pairs = sum(x[i] * x[j] * (v[i] @ v[j]) for i in range(len(x)) for j in range(i))
    assert quality.predict(at, values, stats, model) == pytest.approx(0.3 + model[1][index] @ x + pairs)
    assert len(quality.Reader().features(None)[0]) == 0


def test_chi_square_and_piece_search():
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-2)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 16))
    basis = ann.directions(16)
    piece = ann.Piece(np.arange(700), x.astype(np.float32), x @ basis)
    d, ids = piece.nearest(5, x[5].astype(np.float32).astype(float), x[5] @ basis, 10, 1e9, float("inf"))
    true = np.sqrt(((x.astype(np.float32).astype(float) - x[5].astype(np.float32)) ** 2).sum(axis=1))
    true[5] = np.inf
    assert ids.tolist() == np.argsort(true)[:10].tolist() and np.allclose(d, np.sort(true)[:10])


def test_long_runs_are_searched_in_time():
    import time
    for run in ("a" * 1_000_000 + " x@y", "a.b@" * 200_000, "x@" + "a" * 1_000_000, "1" * 1_000_000, "A" * 1_000_000 + " Aa " * 1000, "+1 " * 300_000):
        start = time.process_time()
        pii.find(run)
        assert time.process_time() - start < 5, run[:10]


def test_what_is_no_phone():
    for text in ("order 1234-5678-9012", "2023 1000 2000"):
        assert pii.find(text) == []
    for text in ("+49 1234-5678-9012", "(030) 1234 5678", "555-123-4567", "138-1234-5678"):
        assert [m[2] for m in pii.find(text)] == ["phone"], text


def test_toxicity_learns_the_words_of_many_texts_at_once():
    bad = toxicity.windows(toxicity.fold("idiot"))
    table, texts = toxicity._unit(bad)[0].astype(float), [f"word{k} idi ot{k} some body i d i o t" for k in range(40)] + [None, "", "Ünï çode"]
    single, whole = (toxicity.Scorer(table, 0.0, cache_size=n) for n in (50, 10_000))
    calls = []
    for kept in (whole.words, whole.joins):
        kept.make = lambda words, make=kept.make: calls.append(len(words)) or make(words)
    assert whole.scores(texts) == [single.score(t) for t in texts]
    assert len(calls) == 2 and min(calls) > 40                     # not once a text
    assert len(single.words.new) + len(single.words.older) <= 2 * 25 + 50


def test_folding_goes_letter_by_letter():
    for word in ("", "idiot", "I-d1o_t!", "naïve", "ÅngstrÖm", "日本語x", "٣ab", "\x00\x7f", "ß²ªz", "𝒜b"):
        slow = bytes(ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 4 for c in word if c.isalpha())
        assert toxicity.fold(word) == slow
