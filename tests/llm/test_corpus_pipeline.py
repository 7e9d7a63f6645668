"""The corpus pipeline, stage by stage, against brute force on the smallest table."""

import collections
import functools
import hashlib
import os
import sys
import zlib

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from test_llm_operators import brute_components, brute_line_dedup, brute_targets, words  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark):
    import corpus_pipeline as cp
    from tokenizers import Tokenizer
    from winnow.llm import common, quality
    from winnow.llm.line_dedup import _distance_within
    from winnow.llm.queries import byte_bpe_path

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, after, frames = docs.columns, {}, {}
    df = docs
    for name, stage in cp.STAGES:
        df = frames[name] = common.written(stage(spark, df, SF), name)
        after[name] = df.collect()
        if name != cp.STAGES[-1][0]:
            assert df.columns == columns, name
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "mix_sources", "bpe_encode_decode"]

    # quality: exactly the rows that the classifier does not reject, unchanged; few good labels lost
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels.filter(~quality.held_out(labels["doc_id"])))
    scored = quality.classify(docs, model).collect()
    assert sorted(r.doc_id for r in scored if r["__predicted"] == 1) == sorted(r.doc_id for r in after["quality_classifier"])
    good = {r.doc_id for r in labels.collect() if r.quality == 1} & {r.doc_id for r in scored}
    assert len(good & {r.doc_id for r in after["quality_classifier"]}) >= 0.95 * len(good)

    # line dedup: all rows stay; no line goes that a loop over all pairs of lines leaves, and
    # of those that it takes out for their similarity, nine of ten go; repeats all go
    before = sorted((r.doc_id, r.text) for r in after["quality_classifier"])
    n_lines = lambda rows: {i: collections.Counter((t or "").split("\n")) for i, t in rows}
    had, got = n_lines(before), n_lines((r.doc_id, r.text) for r in after["line_dedup"])
    # an edit changes two pairs of characters at most, on either side: a bound that spares most distances
    profile = functools.cache(lambda t: np.bincount([zlib.crc32(t[i:i + 2].encode()) % 256 for i in range(len(t) - 1)], minlength=256))

    def near(a, b):
        limit = int(max(len(a), len(b)) * 0.2 + 1e-9)
        return abs(len(a) - len(b)) <= limit and np.abs(profile(a) - profile(b)).sum() <= 4 * limit and _distance_within(a, b, limit)

    fuzzy, repeats = n_lines(brute_line_dedup(before, 64, 0.8, near)[0]), n_lines(brute_line_dedup(before, -1, 0.8)[0])
    assert set(got) == set(had) and all(not fuzzy[i] - got[i] - collections.Counter([""]) for i in had)
    assert all(not got[i] - repeats[i] - collections.Counter([""]) for i in had)
    similar = sum((repeats[i] - fuzzy[i]).total() for i in had)
    assert similar > 10 and sum((repeats[i] - got[i]).total() for i in had) >= 0.9 * similar
    assert all(r.n_chars == len(r.text) for r in after["line_dedup"])

    # near-dedup: the smallest id of each group stays
    groups = brute_components([(r.doc_id, r.text) for r in after["line_dedup"]])
    assert sorted(r.doc_id for r in after["simhash_near_dedup"]) == sorted({c for _, _, c in groups})

    # mixing: whole copies, at most three, each source near its target
    kept, mixed = after["simhash_near_dedup"], after["mix_sources"]
    copies = collections.Counter(r.doc_id for r in mixed)
    assert set(copies) <= {r.doc_id for r in kept} and max(copies.values()) <= 3
    sizes = collections.Counter()
    for r in kept:
        sizes[r.source] += len(words(r.text))
    targets = brute_targets(dict(sizes))
    largest = max(len(words(r.text)) for r in kept)
    for s in sizes:
        assert abs(sum(len(words(r.text)) for r in mixed if r.source == s) - targets[s]) <= 1.5 * largest

    # encoding: the tokenizers library, and the decoded text is the text
    tok = Tokenizer.from_file(byte_bpe_path())
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for r in mixed:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(r.text or "")))
    assert sorted(map(tuple, after["bpe_encode_decode"])) == sorted(expected)


def test_run_gives_the_last_stage(spark):
    import __spark_entry__ as e

    out = e.queries()["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
