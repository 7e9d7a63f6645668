"""Lattice scores against the sum over listed segmentations and a plain loop over all texts."""

import collections
import math
import os
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fixtures_llm as fx  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def small_vocabulary():
    from winnow.llm.subword_lm import Vocabulary, _normalised

    begin = (b"", b"a", b"ab", b"ka")
    go_on = (*(bytes((b,)) for b in range(256) if not 65 <= b <= 90), b"ab", b"ba", b"abc", b"ra", b"kara", "é".encode())
    rng = np.random.default_rng(4)
    return Vocabulary(begin, go_on, _normalised(rng.random(len(begin)) + 0.1, rng.random(len(go_on) + 1) + 0.1))


def segmentations(word, begin, go_on):
    """All lists of piece numbers that spell a word."""
    def rest(w):
        if not w:
            yield []
        for n, p in enumerate(go_on):
            if w.startswith(p):
                for more in rest(w[len(p):]):
                    yield [len(begin) + n, *more]

    for n, p in enumerate(begin):
        if word.startswith(p):
            for more in rest(word[len(p):]):
                yield [n, *more]


def listed(word, v):
    """ln of a word's probability and the expected number of each piece, by listing."""
    stop = len(v.begin) + len(v.go_on)
    ways = [[*s, stop] for s in segmentations(word, v.begin, v.go_on)]
    p = [math.exp(sum(v.weights[i] for i in w)) for w in ways]
    counts = np.zeros(len(v.weights))
    for w, x in zip(ways, p):
        for i in w:
            counts[i] += x / sum(p)
    return math.log(sum(p)), counts


WORDS = [b"a", b"ab", b"abab", b"kara", b"karaabcab", b"x", "éa".encode(), b"\xc3", b"abcabcab"]


def test_forward_sums_all_segmentations_and_expected_counts_follow(monkeypatch):
    from winnow.llm import subword_lm as lm

    v = small_vocabulary()
    lattice = lm.Lattice(v.begin, v.go_on)
    want = [listed(w, v) for w in WORDS]
    for size in (1 << 17, 5):
        monkeypatch.setattr(lm, "BATCH_BYTES", size)
        assert np.allclose(lattice.log_probability(WORDS, v.weights), [p for p, _ in want], rtol=1e-12)
        assert np.allclose(lattice.expected(WORDS, v.weights), sum(c for _, c in want), rtol=1e-10, atol=1e-12)
    assert len(lattice.log_probability([], v.weights)) == 0 and lattice.expected([], v.weights).sum() == 0


def test_a_very_long_word_does_not_underflow():
    from winnow.llm import subword_lm as lm

    v = small_vocabulary()
    got = lm.Lattice(v.begin, v.go_on).log_probability([b"ab" * 20000], v.weights)[0]
    assert math.isfinite(got) and got < -20000


def test_words_probabilities_sum_to_at_most_one():
    from winnow.llm import subword_lm as lm

    v = lm.Vocabulary((b"", b"a"), (b"a", b"b", b"ab"), lm._normalised(np.array([0.5, 0.5]), np.array([0.2, 0.1, 0.1, 0.6])))
    words = [b""]
    every = []
    for _ in range(9):
        words = [w + c for w in words for c in (b"a", b"b")]
        every += words
    total = np.exp(lm.Lattice(v.begin, v.go_on).log_probability(every, v.weights)).sum()
    alone = 0.5 * 0.6  # the bare beginning and the end spell the empty word
    assert 0.97 < total + alone <= 1 + 1e-9


def brute(rows, v, rounds):
    """(doc_id, n_tokens, n_known, train_tokens, base, score) by loops over (doc_id, text)."""
    from winnow.llm.subword_lm import Vocabulary, _normalised

    texts = [(d, (t or "").encode().lower().split()) for d, t in rows]
    counts = collections.Counter()
    for d, words in texts:
        if d is not None and zlib.crc32(str(d).encode()) % 10:
            counts.update([*words, b""])
    total, types, once = sum(counts.values()), len(counts), sum(c == 1 for w, c in counts.items() if w)
    start = np.exp(v.weights)
    for _ in range(rounds):
        got = start + sum((listed(w, v)[1] for w in counts if w), np.zeros(len(start)))
        v = Vocabulary(v.begin, v.go_on, _normalised(got[:len(v.begin)], got[len(v.begin):]))
    new, known, out = (once + 1) / (total + 2), {}, []
    for d, words in texts:
        base = score = n_known = 0
        for w in [*words, b""]:
            c = counts[w]
            if w not in known:
                seen = (1 - new) * (c + (w == b"")) / (total + 1)
                known[w] = math.log10(seen + (new * math.exp(listed(w, v)[0]) if w else 0))
            n_known += c > 0
            base += math.log10((c + 0.1) / (total + 0.1 * (types + 1)))
            score += known[w]
        out.append((d, len(words) + 1, n_known, total, base, score))
    return out


def data():
    words = ["a", "ab", "Kara", "abc", "x9", "é", "kaRA", "karab", "bab"]
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 12)).tolist()) + ("\tnew%d" % i if i % 3 == 0 else "")) for i in range(60)]
    return [*rows, (60, None), (61, ""), (62, " \n\x0b\f\r "), (None, "kara only here"), (5, "twice"), (5, "twice"), (5, "twice"), (63, "AÉ Ab")]


@pytest.mark.parametrize("rounds,frequent", [(0, 20000), (2, 20)])
def test_scores_match_brute_force(spark, monkeypatch, rounds, frequent):
    from winnow.llm import subword_lm as lm

    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "KEEP_WORDS", 4)
    rows, v = data(), small_vocabulary()
    df = spark.createDataFrame([(d, t, 1, "x", 2.0) for d, t in rows], "doc_id long, text string, __row long, word string, c double")
    out = lm.score_texts(df, ~lm.held_out(F.col("doc_id")), v, rounds=rounds)
    assert out.columns == ["doc_id", "__row", "word", "c", "__n_tokens", "__n_known", "__train_tokens", "__base_score", "__score"]
    key = lambda r: (str(r[0]), r[1], round(r[5], 6))
    got = sorted([(r[0], *r[4:]) for r in out.collect()], key=key)
    want = sorted(brute(rows, v, rounds), key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-9, atol=1e-9)


def test_awkward_rows_empty_tables_and_nothing_to_learn_from(spark):
    from winnow.llm import subword_lm as lm
    from winnow.llm.queries import piece_path

    v = lm.read_vocabulary(piece_path())
    assert math.isclose(np.exp(v.weights[:len(v.begin)]).sum(), 1) and math.isclose(np.exp(v.weights[len(v.begin):]).sum(), 1)
    learn = lambda: ~lm.held_out(F.col("doc_id"))
    got = lm.score_texts(fx.docs(spark), learn(), v, rounds=1).collect()
    assert len(got) == len(fx.rows()) and all(math.isfinite(r["__score"]) and r["__score"] < 0 for r in got)
    assert lm.score_texts(fx.empty(spark), learn(), v).count() == 0
    none = lm.score_texts(fx.docs(spark, fx.rows()[:5]), F.lit(False), v).collect()
    assert {(r["__train_tokens"], r["__n_known"], round(r["__base_score"], 9)) for r in none} == {(0, 0, 0.0)}
    assert all(math.isfinite(r["__score"]) for r in none)


def test_held_out_texts_of_the_given_table(spark):
    """Fitting the weights lifts the probability of texts that were not learned from."""
    from winnow.llm import subword_lm as lm
    from winnow.llm.queries import piece_path

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    v = lm.read_vocabulary(piece_path())
    per_token = {}
    for rounds in (0, 2):
        r = lm.score_texts(docs, ~lm.held_out(F.col("doc_id")), v, rounds=rounds).filter(lm.held_out(F.col("doc_id"))).agg(
            F.sum("__score"), F.sum("__n_tokens")).first()
        per_token[rounds] = r[0] / r[1]
    assert per_token[2] > per_token[0] + 0.3
