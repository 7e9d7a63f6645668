"""The training-data operators against brute force on small tables with awkward rows."""

import collections
import hashlib
import itertools
import math
import os
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fixtures_llm as fx  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SF = "/root/testdata/sf0.001"


def words(t):
    return (t or "").encode().split()


# ---------------------------------------------------------------- 1 sharding

def xx(value, seed):
    import random

    import xxhash

    return xxhash.xxh64_intdigest(value, seed=seed)


def brute_shard(doc_id, weights):
    seed = 42 if doc_id is None else xx(doc_id.to_bytes(8, "little", signed=True), 42)
    best = None
    for s, w in enumerate(weights):
        if w <= 0:
            continue
        u = ((xx(s.to_bytes(4, "little"), seed) >> 12) + 0.5) / 2.0**52
        score = -w / math.log(u)
        if best is None or score > best[0]:
            best = (score, s)
    return best[1]


def test_sharding_matches_brute_force_and_moves_into_the_new_shard_only(spark):
    from winnow.llm.sharding import shard_records

    weights = [1.0, 2.0, 0.0, 0.5]
    got = shard_records(fx.docs(spark), ["doc_id"], weights, [*weights, 1.5]).collect()
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode()),
                                brute_shard(r[0], weights), brute_shard(r[0], [*weights, 1.5])) for r in fx.rows())
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    assert all(r.shard == r.grown_shard or r.grown_shard == 4 for r in got)
    assert {r.shard for r in got} == {0, 1, 3}
    for s, n in collections.Counter(r.shard for r in got).items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    assert shard_records(fx.empty(spark), ["doc_id"], weights).count() == 0


def test_sharding_follows_the_weights(spark):
    from winnow.llm.sharding import rendezvous_shard

    n = dict(spark.range(40000).groupBy(rendezvous_shard([F.col("id")], [1.0, 3.0]).alias("s")).count().collect())
    assert abs(n[1] / 40000 - 0.75) < 0.02


# ---------------------------------------------------------------- 2 line dedup

def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def line_simhash(norm):
    ws = set(norm.split(" "))
    ones = [sum(xx(w.encode(), 0) >> i & 1 for w in ws) for i in range(64)]
    return sum(1 << i for i in range(64) if ones[i] * 2 > len(ws))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute_line_dedup(data, bits, similarity, similar=None):
    """Texts after a loop over all pairs of lines, and the links; ``similar`` replaces the plain edit distance."""
    from winnow.llm.line_dedup import normalise

    norms = {normalise(x) for _, t in data for x in (t or "").split("\n")} - {""}
    fps = {n: line_simhash(n) for n in norms}
    links = [(a, b) for a, b in itertools.combinations(sorted(norms), 2)
             if (fps[a] ^ fps[b]).bit_count() <= bits
             and (similar(a, b) if similar else 1 - levenshtein(a, b) / max(len(a), len(b)) >= similarity - 1e-12)]
    group = components(norms, links)
    seen, out = set(), []
    for i, t in data:
        if t is None:
            out.append((i, None))
            continue
        kept = []
        for x in t.split("\n"):
            g = group.get(normalise(x))
            if g is None or g not in seen:
                kept.append(x)
            seen.add(g)
        out.append((i, "\n".join(kept)))
    return out, links


def test_line_dedup_matches_brute_force(spark):
    from winnow.llm.line_dedup import dedup_lines

    long = " ".join(f"{w}{i}" for i, w in enumerate(fx.WORDS * 3))
    data = [(1, "alpha beta gamma delta\n\nOther line here"), (2, "Alpha, beta gamma delta!\nunique words stand here"), (3, None),
            (4, ""), (5, "x\nx\nX"), (6, long + " end"), (7, long.replace("kara0", "kara7") + " end\n" + long), (8, "!!!\n!!!\n???"),
            (9, "delta gamma beta alpha"), (10, "Other  line here."), (11, long + " ends"), (12, "  \n  \n")]
    want, links = brute_line_dedup(data, 3, 0.8)
    assert links, "the fixture needs fuzzy links"
    df = spark.createDataFrame([(i, t, None, None, None, *([1] * 13)) for i, t in data], fx.SCHEMA)
    got = dedup_lines(df).collect()
    assert sorted((r.doc_id, r.text) for r in got) == want
    assert got[0].__fields__[:-2] == df.columns


def edited_lines(rng, n_edits):
    """Pairs (line, copy with edited words) of many lengths whose edit similarity is 0.8 or more."""
    from winnow.llm.line_dedup import _distance_within

    out = []
    for n in list(range(5, 60, 2)) * 4:
        w = [rng.choice(fx.WORDS) + rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(n)]
        v = list(w)
        for i in rng.sample(range(n), n_edits):
            kind = rng.randrange(3)
            v[i] = "q" + v[i][1:] if kind == 0 else rng.choice(fx.WORDS) if kind == 1 else v[i] + " " + rng.choice(fx.WORDS)
        a, b = " ".join(w), " ".join(v)
        if _distance_within(a, b, int(max(len(a), len(b)) * 0.2 + 1e-9)):
            out.append((a, b))
    return out


@pytest.mark.parametrize("n_edits, recall", [(1, {9: 1.0, 19: 1.0, 49: 1.0, 99: 1.0}), (2, {9: 0.9, 19: 0.9, 49: 0.9, 99: 0.9})])
def test_fuzzy_line_recall_by_length_without_a_bit_cut(spark, n_edits, recall):
    import random

    from winnow.llm.line_dedup import dedup_lines

    pairs = edited_lines(random.Random(11), n_edits)
    assert len(pairs) > 60
    data = [(i, t) for k, (a, b) in enumerate(pairs) for i, t in ((2 * k, a), (2 * k + 1, b))]
    df = spark.createDataFrame([(i, t, None, None, None, *([1] * 13)) for i, t in data], fx.SCHEMA)
    left = {r.doc_id: r.text for r in dedup_lines(df, any_bits=True).collect()}
    assert all(left[2 * k] == a for k, (a, _) in enumerate(pairs))  # different lines stay
    low = 0
    for high, share in recall.items():
        of = [k for k, (a, _) in enumerate(pairs) if low < len(a.split()) <= high]
        low = high
        if of:
            found = sum(left[2 * k + 1] == "" for k in of) / len(of)
            assert found >= share, (high, found)


def test_lines_without_a_bit_cut_match_brute_force(spark):
    from winnow.llm.line_dedup import dedup_lines

    data = [(1, "alpha beta gamma delta\nétrévisions"), (2, "alpha beta gamma delts\nétrévisiont"), (3, "the quick brown fox jumps over a dog\nxy"),
            (4, "the quick brown fox jumped over a dog\nx"), (5, "a quick brown fox jumped over a dog"), (6, "nothing like any other line")]
    want, _ = brute_line_dedup(data, 64, 0.8)
    df = spark.createDataFrame([(i, t, None, None, None, *([1] * 13)) for i, t in data], fx.SCHEMA)
    assert sorted((r.doc_id, r.text) for r in dedup_lines(df, any_bits=True).collect()) == want
    assert dedup_lines(fx.empty(spark), any_bits=True).count() == 0


@pytest.mark.parametrize("any_bits", [False, True])
def test_line_dedup_keeps_rows_and_handles_awkward_ones(spark, any_bits):
    from winnow.llm.line_dedup import dedup_lines

    got = dedup_lines(fx.docs(spark), any_bits=any_bits).select("doc_id", "text", "__lines", "__removed").collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in fx.rows())
    first = {r[0]: r[1] for r in reversed(fx.rows()) if r[0] is not None}
    by_id = {r.doc_id: r for r in got}
    assert by_id[20].text == first[20]  # a first occurrence stays whole
    assert all(r.text == "" for r in got if r.doc_id in (60, 62, 64))  # exact copies lose all lines
    assert all((r.text is None) == (r["__lines"] == 0) for r in got)
    assert dedup_lines(fx.empty(spark), any_bits=any_bits).count() == 0


def test_a_link_between_groups_merges_them(spark):
    """A chain whose middle line is not the one that stands for its ends: the first pass leaves
    groups apart that only a pair of other members links."""
    from winnow.llm.line_dedup import dedup_lines

    w = [f"{a}{i}" for i, a in enumerate(fx.WORDS[:30])]
    swap = lambda *at: " ".join("changed" if i in at else x for i, x in enumerate(w))
    chain = [swap(), swap(3), swap(3, 9), swap(3, 9, 15), swap(3, 9, 15, 21), swap(3, 9, 15, 21, 27), swap(1, 3, 9, 15, 21, 27)]
    data = list(enumerate([*chain, "a line of its own"]))
    want, links = brute_line_dedup(data, 64, 0.8)
    df = spark.createDataFrame([(i, t, None, None, None, *([1] * 13)) for i, t in data], fx.SCHEMA)
    assert links and sorted((r.doc_id, r.text) for r in dedup_lines(df, any_bits=True).collect()) == want


# ---------------------------------------------------------------- 3 SimHash near-dedup

def brute_fingerprint(t, k=4):
    w = (t or "").encode().lower().split()
    sh = [b" ".join(w)] if 0 < len(w) < k else [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)]
    if not sh:
        return 0
    ones = [0] * 64
    for s in sh:
        h = xx(s, 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if ones[i] * 2 > len(sh))


def test_lines_of_a_large_end_meet_in_tiles(spark, monkeypatch):
    import random

    from winnow.llm import line_dedup

    monkeypatch.setattr(line_dedup, "FEW_LINES", 8)
    monkeypatch.setattr(line_dedup, "TILE_LINES", (40, 40))
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    start = [word() for _ in range(8)]
    tails = [[word() for _ in range(9)] for _ in range(3)]
    lines = [" ".join(start + [word() if i == k % 9 else w for i, w in enumerate(tails[k % 3])]) for k in range(90)]
    lines += [" ".join(start + [word() for _ in range(9)]) for _ in range(30)]
    ends = [line_dedup._ends(x.encode().split(), 0.8) for x in lines]
    groups = spark.createDataFrame([(i, len(x), e) for i, (x, e) in enumerate(zip(lines, ends))], "h1 long, size int, ends array<long>")
    texts = spark.createDataFrame(list(enumerate(lines)), "h1 long, norm string")
    rooted = groups.selectExpr("h1", "h1 AS root")
    held = line_dedup._held_ends(groups, 0.8)
    got = [tuple(r) for r in line_dedup._apart_by_ends(held, rooted, groups, texts, 0.8).collect()]

    def parts(links):
        root = list(range(len(lines)))
        for a, b in links:
            root = [root[a] if r == root[b] else r for r in root]
        return sorted(sorted(i for i, r in enumerate(root) if r == x) for x in set(root))

    near = [(a, b) for a, b in itertools.combinations(range(len(lines)), 2)
            if set(ends[a]) & set(ends[b]) and line_dedup._distance_within(lines[a], lines[b], int(max(len(lines[a]), len(lines[b])) * 0.2 + 1e-9))]
    assert all(x in set(near) for x in got) and parts(got) == parts(near) and len(parts(near)) == 33
    # not a row for each pair: before, each of the pairs was one
    assert len(near) > 1200 and len(set(got)) < 6 * len(lines)


def test_distances_of_many_pairs_are_exact(monkeypatch):
    import random

    from winnow.llm import line_dedup

    rng = random.Random(5)
    pairs, limits = [], []
    for _ in range(600):
        letters = rng.choice(["ab", "abcdefgh ", "abcdefghijklmnop \u65e5\u672c\xe9\U0001f600"])
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(70)))
        b = list(a if rng.random() < 0.8 else rng.choices(letters, k=rng.randrange(70)))
        for _ in range(rng.randrange(25)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = rng.choices(letters, k=rng.randrange(2))
        pairs.append((a, "".join(b)))
        limits.append(rng.choice([max(map(len, pairs[-1])) // 5, rng.randrange(40)]))
    want = [levenshtein(a, b) <= most for (a, b), most in zip(pairs, limits)]
    assert 100 < sum(want) < 500
    for chars, look, long in ((1 << 16, 16, 1024), (300, 3, 1024), (1 << 16, 16, 30)):
        monkeypatch.setattr(line_dedup, "BATCH_CHARS", chars)
        monkeypatch.setattr(line_dedup, "LOOK_EVERY", look)
        monkeypatch.setattr(line_dedup, "LONG_TEXT", long)
        assert line_dedup._distances_within(pairs, limits).tolist() == want
    assert line_dedup._distances_within([], []).tolist() == []


def test_unlike_lines_of_an_end_take_no_distance_each(monkeypatch):
    import random

    import pandas as pd
    from winnow.llm import line_dedup

    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcde") for _ in range(5))
    lines = ["they all begin with " + " ".join(word() for _ in range(8)) for _ in range(150)]
    lines += [x[:40] + "q" + x[41:] for x in lines[:5]]
    counted = []
    monkeypatch.setattr(line_dedup, "_distance", lambda *x, f=line_dedup._distance: counted.append(1) or f(*x))
    rows = pd.DataFrame({"h1": range(len(lines)), "root": range(len(lines)), "tile": 0, "k": 7, "norm": lines, "lines": len(lines)})
    rows["size"], rows["ends"] = rows["norm"].str.len(), [[7, 9 + i] for i in range(len(lines))]
    rows["ends"] = rows["ends"].map(lambda x: pd.Series(x).to_numpy())
    got = line_dedup._linked_in_tiles(0.8)(rows)
    assert sorted(zip(got["a"], got["b"])) == [(i, 150 + i) for i in range(5)]
    assert len(counted) < 20  # before: thousands


@pytest.mark.parametrize("parts", [False, True])
def test_shared_ends_and_near_fingerprints_match_brute_force(spark, monkeypatch, parts):
    import random

    from winnow.llm import line_dedup

    if parts:  # a partition is sifted many times, and blocks are full at once
        monkeypatch.setattr(line_dedup, "SIFT_ROWS", 40)
        monkeypatch.setattr(line_dedup, "FEW_OF_BLOCK", 3)
    rng = random.Random(3)
    lines = [(i, rng.choice([5, 6, 9, 20, 26, 40, 300]), rng.sample([-1, -2, 5, *range(100, 400)], rng.randrange(6))) for i in range(300)]
    held = line_dedup._held_ends(spark.createDataFrame(lines + lines[:90], "h1 long, size int, ends array<long>"), 0.8)
    near = lambda x, y: abs(x - y) <= max(x, y) * 0.2 + 1e-9
    want = [(i, n, k) for i, n, ends in lines for k in ends if any(j != i and k in e and near(n, m) for j, m, e in lines)]
    assert sorted(tuple(r) for r in held.collect()) == sorted(want) and want

    fps = {rng.getrandbits(64) for _ in range(80)}
    fps |= {x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))) for x in fps for _ in range(3)}
    fps |= {x << 12 | 99 << 50 for x in range(40)}  # many of one block
    fps = [x - (1 << 64) if x >> 63 else x for x in fps]
    sizes = [rng.choice([(10, 10), (12, 14), (100, 100)]) for _ in fps]
    classes = spark.createDataFrame([(x, *y, 1, 1) for x, y in zip(fps, sizes)], "fp long, low int, high int, head long, members long")
    got = [tuple(r) for r in line_dedup._near_fingerprints(classes, 3, 0.8).collect()]
    could = lambda x, y: x[1] + 0.5 >= y[0] * 0.8 and y[1] + 0.5 >= x[0] * 0.8
    want = [(x, y) for (x, m), (y, n) in itertools.permutations(list(zip(fps, sizes)), 2) if x < y and ((x ^ y) & (1 << 64) - 1).bit_count() <= 3 and could(m, n)]
    assert sorted(got) == sorted(want) and len(want) > 50


def test_blocks_of_lines_hash_as_single_lines_do(monkeypatch):
    import random

    import pyarrow as pa
    import xxhash
    from winnow.llm import line_dedup

    rng = random.Random(4)
    pieces = ["a", "Bb", "\u0130x", "d-e", "??", "  ", "\t", "\xdf_", "\xa0", "\x1c", "\u65e5\u672c", "\r", "x" * 31, "y" * 32, "z" * 70, "abcd1234", "abc"]
    texts = ["".join(rng.choice(pieces) + rng.choice(["\n", "", *[" "] * 6]) for _ in range(rng.randrange(90))) for _ in range(150)]
    texts += ["", None, "\n\n", "!!! ?\n\n ..", "one"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "key", "text"])
    want = []
    for i, t in enumerate(texts):
        for at, line in enumerate((t or "").split("\n")):
            if norm := line_dedup.normalise(line):
                want.append((i, at, norm))
    whole = []
    for size in (1 << 21, 40):  # 40: texts are cut into pieces
        monkeypatch.setattr(line_dedup, "BLOCK_BYTES", size)
        got = [r for b in line_dedup._hashed(iter([batch]), 0.8) for r in b.to_pylist()]
        assert [(r["doc_id"], r["line"]) for r in got] == [(i, at) for i, at, _ in want]
        for r, (_, _, norm) in zip(got, want):
            words = norm.encode().split()
            digest = xxhash.xxh3_128_digest(norm.encode())
            assert (r["h1"], r["h2"], r["size"]) == (*(int.from_bytes(digest[x:x + 8], "big", signed=True) for x in (0, 8)), len(norm))
            assert r["fp"] & (1 << 64) - 1 == line_simhash(norm) & (1 << 64) - 1
            assert len(set(r["ends"])) == len(r["ends"]) and r["ends"] == line_dedup._ends(words, 0.8)
        whole.append(got)
    assert whole[0] == whole[1] and len(want) > 500


def test_tables_of_line_dedup_go_when_its_lines_are_known(spark):
    from winnow.llm.line_dedup import dedup_lines
    from winnow.session import shared_dir

    folder = shared_dir(spark, "winnow-llm").removeprefix("file:")
    there = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before = there()
    data = [(1, "one two three four five\nsix seven eight nine ten"), (2, "one two three four fives\nsix seven eight nine ten"), (3, None)]
    out = dedup_lines(spark.createDataFrame(data, "doc_id long, text string"), any_bits=True)
    assert {x.rpartition("-")[0] for x in there() - before} == {"lines-gone"}
    assert {r.doc_id: r.text for r in out.collect()} == {1: data[0][1], 2: "", 3: None}


def test_fingerprint_in_blocks(monkeypatch):
    from winnow.llm import simhash

    texts = [r[1] for r in fx.rows()]
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]


def brute_components(data, bits=4):
    fps = {brute_fingerprint(t) for _, t in data}
    links = [(a, b) for a, b in itertools.combinations(sorted(fps), 2) if (a ^ b).bit_count() <= bits]
    root = components(fps, links)
    smallest = {}
    for i, t in data:
        r = root[brute_fingerprint(t)]
        if i is not None:
            smallest[r] = min(i, smallest.get(r, i))
    return [(i, brute_fingerprint(t), smallest.get(root[brute_fingerprint(t)])) for i, t in data]


def test_simhash_groups_match_brute_force(spark):
    from winnow.llm.simhash import drop_near_duplicates, simhash_groups

    data = [(r[0], r[1]) for r in fx.rows()]
    got = simhash_groups(fx.docs(spark)).collect()
    want = brute_components(data)
    assert collections.Counter((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got) == collections.Counter(want)
    kept = drop_near_duplicates(fx.docs(spark))
    assert kept.columns == fx.docs(spark).columns
    root = components({f for _, f, _ in want}, [(a, b) for a, b in itertools.combinations({f for _, f, _ in want}, 2) if (a ^ b).bit_count() <= 4])
    groups = {root[f]: c for _, f, c in want}  # an id with two texts may stand for two groups
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(groups.values())
    assert drop_near_duplicates(fx.empty(spark)).count() == 0


def test_near_pairs_find_every_pair_and_pigeonring_drops_none(spark):
    from winnow.llm.simhash import near_pairs, pigeonring

    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for x in base.tolist():
        for d in range(0, 9):
            y = x
            for b in rng.choice(64, d, replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    signed = sorted(x - 2**64 if x >= 2**63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = {(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    got = [tuple(r) for r in near_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    pairs = spark.createDataFrame(sorted(want), "a long, b long")
    assert pairs.filter(~pigeonring(F.col("a").bitwiseXOR(F.col("b")), 4)).count() == 0
    far = spark.createDataFrame([(0, int(x) >> 1) for x in base.tolist()], "a long, b long")
    assert far.filter(pigeonring(F.col("a").bitwiseXOR(F.col("b")), 4)).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    from winnow.llm.components import connected_components

    rng = np.random.default_rng(2)
    name = rng.permutation(2000).tolist()
    edges = [(i, i + 1) for i in range(300)] + [(400, i) for i in range(401, 700)] + [(i, 700 + (i - 699) % 50) for i in range(700, 750)] + [(800, 800), (None, 3)]
    edges = [(None if a is None else name[a], name[b]) for a, b in edges]
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = components({x for e in real for x in e}, real)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- 4 quality

def test_quality_classifier_on_held_out_rows(spark):
    import __spark_entry__ as e

    sf = "/root/testdata/sf0.1"
    got = e.queries()["op4_compression_classifier"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.filter("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert right > 0.95 and auc > 0.97, (right, auc)
    assert sum(r.predicted for r in rows if r.quality == 1) / len(good) > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.select("doc_id", "held_out").collect())


def test_quality_handles_awkward_rows_and_few_labels(spark):
    from winnow.llm import quality

    docs = fx.docs(spark)
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(40)] + [(None, 1, 1), (41, None, 1), (3, 0, 1), (9999, 1, 1)], "doc_id long, quality int, text int")
    model = quality.fit(docs, labels)
    out = quality.classify(docs, model)
    rows = out.select("text", "__score", "__predicted").collect()
    assert out.count() == len(fx.rows()) and all(0 <= r["__score"] <= 1 for r in rows)
    assert all(r["__predicted"] == (r["__score"] >= 0.3) for r in rows)
    assert len({r["__score"] for r in rows if not r["text"]}) == 1  # null as empty
    one = quality.fit(docs, labels.filter("quality = 1"))
    assert quality.classify(docs, one).filter("__predicted = 0").count() == 0
    none = quality.classify(docs, quality.fit(docs, labels.limit(0))).select("__score").distinct().collect()
    assert [r[0] for r in none] == [0.5]
    assert quality.classify(fx.empty(spark), quality.fit(fx.empty(spark), labels)).count() == 0


# ---------------------------------------------------------------- 5 fingerprints

def brute_signature(text, samples):
    counts = collections.Counter(words(text))
    out = []
    for j in range(samples):
        best = math.inf
        for w, n in counts.items():
            term = xx(w, 42).to_bytes(8, "little")
            h, g = (xx((2 * j + k).to_bytes(4, "little"), xx(term, 42)) for k in (0, 1))
            u = lambda bits, size: (bits + 0.5) * 2.0**-size
            r = -math.log(u(h >> 43, 21) * u(h >> 22 & (1 << 21) - 1, 21))
            beta = u(g & (1 << 32) - 1, 32)
            t = math.floor(math.log(n) / r + beta)
            best = min(best, math.log(-math.log(u(h & (1 << 22) - 1, 22) * u(g >> 32, 32))) - r * (t - beta) - r)
        out.append(best)
    return out


def test_fingerprints_edits_and_neighbours_match_brute_force(spark):
    from winnow.llm import cws

    data = [r for r in fx.rows() if not (r[1] and len(r[1]) > 10000)]
    samples = 4
    got = cws.fingerprint_edits(fx.docs(spark, data), samples=samples).collect()
    assert len(got) == len(data)
    by_text = collections.defaultdict(set)
    text_of = {}
    for r in data:
        text_of.setdefault(r[0], set()).add(r[1] or "")
    # ids with one text and followed by one: their edited texts are known
    ids = sorted((i for i in text_of if i is not None), reverse=True)
    after = dict(zip(ids, ids[1:]))
    checked = 0
    for r in got:
        if r.doc_id is None or len(text_of[r.doc_id]) > 1:
            continue
        (t,) = text_of[r.doc_id]
        assert r.n_chars == len(t)
        by_text[t].add(r.fingerprint)
        nxt = after.get(r.doc_id)
        if nxt is None or len(text_of[nxt]) > 1 or r.doc_id == 7:
            continue
        (u,) = text_of[nxt]
        half = len(t) // 2
        edited = t[:len(t) - half] + u[:half]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (brute_signature(x, samples) for x in (t, edited, u))
        close = lambda x, y: sum(p == q or abs(p - q) < 1e-12 for p, q in zip(x, y)) / samples
        assert abs(r.near_edited - close(a, b)) < 1e-9 and abs(r.near_next - close(a, c)) < 1e-9
        checked += 1
    assert checked > 40 and all(len(v) == 1 for v in by_text.values())
    assert cws.fingerprint_edits(fx.empty(spark)).count() == 0


def test_fingerprinting_edits_writes_the_texts_to_one_shuffle(spark):
    from winnow.llm import cws

    data = [(i, f"aa bb {i}", None, None, None, *([1] * 13)) for i in range(30)]
    out = cws.fingerprint_edits(fx.docs(spark, data), samples=2)
    assert len(out.collect()) == 30
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    written = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line and "Reused" not in line]
    assert len(written) == 1 and any("ReusedExchange" in line and "REPARTITION_BY_NUM" in line for line in plan.splitlines())


def test_last_document_meets_the_first_and_one_meets_itself(spark):
    from winnow.llm import cws

    few = [(i, t, None, None, None, *([1] * 13)) for i, t in ((1, "aa bb"), (2, "cc dd"), (5, "ee ff"))]
    got = {r.doc_id: r.edited_sha256 for r in cws.fingerprint_edits(fx.docs(spark, few)).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in ((5, "ee cc"), (2, "cc aa"), (1, "aa ee"))}
    (one,) = cws.fingerprint_edits(fx.docs(spark, few[:1])).collect()
    assert one.near_next == 1.0


def test_collision_rate_is_generalised_jaccard(spark):
    from winnow.llm import cws

    a, b = "p p p p q r r s t", "p p q q r u s s v w"
    df = spark.createDataFrame([(0, a), (1, b)], "k int, text string")
    s = {r.k: r.signature for r in cws.signatures(df, ["k"], "text", 400).collect()}
    x, y = collections.Counter(a.split()), collections.Counter(b.split())
    true = sum((x & y).values()) / sum((x | y).values())
    same = sum(s[0][8 * i:8 * i + 8] == s[1][8 * i:8 * i + 8] for i in range(400)) / 400
    assert abs(same - true) < 0.08


def test_registered_sample_count_is_close_to_generalised_jaccard(spark):
    import random

    from winnow.llm import cws

    rng = random.Random(8)
    pairs = []
    for k in range(300):
        a = [rng.choice(fx.WORDS) + str(rng.randrange(9)) for _ in range(80)]
        share = 0.02 + 0.6 * k / 300
        b = [w if rng.random() > share else rng.choice(fx.WORDS) + str(rng.randrange(9)) for w in a]
        pairs.append((k, " ".join(a), " ".join(b)))
    flat = spark.createDataFrame([(2 * k + e, t) for k, *ab in pairs for e, t in enumerate(ab)], "k int, text string")
    s = {r.k: r.signature for r in cws.signatures(flat, ["k"], "text").collect()}
    errors = []
    for k, a, b in pairs:
        x, y = collections.Counter(a.split()), collections.Counter(b.split())
        p, q = s[2 * k], s[2 * k + 1]
        n = len(p) // cws.DIGITS
        got = sum(p[i * 8:i * 8 + 8] == q[i * 8:i * 8 + 8] for i in range(n)) / n
        errors.append(got - sum((x & y).values()) / sum((x | y).values()))
    assert math.sqrt(sum(e * e for e in errors) / len(errors)) < 0.075 and max(map(abs, errors)) < 0.3  # four standard errors
    assert abs(sum(errors) / len(errors)) < 0.02


# ---------------------------------------------------------------- 6 licences

def test_known_licences_start_no_python_in_executors(spark):
    from winnow.llm import licenses

    plan = licenses.known_digests(spark)._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan


def test_license_scan_of_texts_and_lines(spark):
    from winnow.llm import licenses

    mit = dict(licenses.KNOWN)["MIT"]
    full = [t for i, t in licenses.KNOWN if i == "MIT" and len(t) > 500][0]
    data = [(1, "Copyright (c) 2020 Jane Doe\n\n" + full.upper().replace('"', "'")), (2, full.replace("sublicense", "sub-licence")),
            (3, "text\nall rights RESERVED\nReleased under the MIT licence!\nAll rights reserved."), (4, None), (5, ""), (6, full + " extra"),
            (7, "© 2001 X"), (8, "(C) me\nLicensed under CC BY-NC 4.0."), (9, "x " * 50000), (5, "")]
    df = spark.createDataFrame([(i, t, None, None, None, *([1] * 13)) for i, t in data], fx.SCHEMA)
    got = [(r.doc_id, r.license_id, r.n_license_lines, r.line_licenses) for r in licenses.scan_licenses(df, licenses.known_digests(spark)).collect()]
    assert mit and sorted(got, key=str) == sorted([
        (1, "MIT", 0, ""), (2, "MIT", 0, ""), (3, None, 3, "LicenseRef-all-rights-reserved,MIT"), (4, None, 0, ""), (5, None, 0, ""),
        (5, None, 0, ""), (6, None, 0, ""), (7, None, 0, ""), (8, "CC-BY-NC-4.0", 1, "CC-BY-NC-4.0"), (9, None, 0, "")], key=str)
    assert licenses.scan_licenses(fx.empty(spark), licenses.known_digests(spark)).count() == 0


# ---------------------------------------------------------------- 7 mixing

def test_whole_licence_texts_under_their_headings(spark):
    from winnow.llm import licenses

    old = [("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
           ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
           ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Released under CC0 1.0."),
           ("MPL-2.0", "This project is licensed under the Mozilla Public License 2.0"), ("AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-only")]
    bsd = licenses._BSD_3.format("copyright holder").replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    whole = [("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 Jane Doe\n\n" + licenses._MIT), *licenses.TEXTS.items(),
             ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Jane Doe\nAll rights reserved.\n\n" + bsd),
             ("Apache-2.0", licenses.TEXTS["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 Jane Doe")),
             ("GPL-3.0-only", licenses._unwrapped(licenses.TEXTS["GPL-3.0-only"]))]
    df = spark.createDataFrame([(k, t, None, None, None, *([1] * 13)) for k, (_, t) in enumerate(old + whole)], fx.SCHEMA)
    got = {r.doc_id: r for r in licenses.scan_licenses(df, licenses.known_digests(spark)).collect()}
    assert [got[k].license_id for k in range(len(got))] == [i for i, _ in old + whole]
    assert all(got[k].line_licenses == i for k, (i, _) in enumerate(old))


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        t = {s: 3.0 * sizes[s] for s in capped} | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if t[s] > 3 * sizes[s]}
        if not over:
            return t
        capped |= over


def test_mixing_targets_copies_and_rows(spark):
    from winnow.llm import mixing

    data = fx.rows()
    got = mixing.sample_copies(fx.docs(spark)).collect()
    sizes = collections.Counter()
    for r in data:
        sizes[r[3]] += len(words(r[1]))
    want = brute_targets(dict(sizes))
    largest = max(len(words(r[1])) for r in data)
    assert collections.Counter((r.doc_id, r.source, r["size"]) for r in got) == collections.Counter((r[0], r[3], len(words(r[1]))) for r in data)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert all(abs(r.target - want[s]) < 1e-6 and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r.copies * r["size"] for r in mine) - want[s]) <= 1.5 * largest
    assert all(0 <= r.copies <= 3 for r in got)
    mixed = mixing.mix_documents(fx.docs(spark))
    assert mixed.columns == fx.docs(spark).columns
    assert collections.Counter(r.doc_id for r in mixed.collect()) == +collections.Counter(
        {i: sum(r.copies for r in got if r.doc_id == i) for i in {r.doc_id for r in got}})
    again = mixing.sample_copies(fx.docs(spark).repartition(5)).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, got))
    assert mixing.mix_documents(fx.empty(spark)).count() == 0


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1, "c": 1000}, {"a": 0, "b": 0, None: 0},
                                   {"a": 5, "b": 2, "c": 1, "d": 1}, {"s": 3, None: 100}, {f"s{i}": (i * 37) % 11 for i in range(20)}])
def test_targets_by_water_filling(spark, sizes):
    from winnow.llm.mixing import source_targets

    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-9 for s in sizes)


# ---------------------------------------------------------------- 8 BPE

def test_bpe_equals_the_tokenizers_library(spark):
    from tokenizers import Tokenizer
    from winnow.llm import bpe
    from winnow.llm.queries import byte_bpe_path

    tok = Tokenizer.from_file(byte_bpe_path())
    docs = fx.docs(spark).union(fx.docs(spark, [(500, "aaaa" * 3000 + " \n\n  \x85 x'll I'VE 123١² \x1c\x1f <|endoftext|><|endoftext", None, None, None, *([1] * 13))]))
    spec = bpe.read_spec(spark, byte_bpe_path())
    out = bpe.encode_documents(docs.select("doc_id", "text", F.coalesce("text", F.lit("")).alias("whole"), "lang"), spec, decoded=True)
    got = out.select("whole", F.col("__ids").alias("ids"), "__decoded", bpe.decode(F.col("__ids"), spec).alias("back")).collect()
    assert len(got) == docs.count() and out.columns == ["doc_id", "whole", "lang", "__ids", "__decoded"]
    for r in got:
        ids = tok.encode(r.whole, add_special_tokens=False).ids
        assert r.ids == ids and r.back == r["__decoded"] == tok.decode(ids, skip_special_tokens=False) == r.whole
    assert bpe.encode_documents(fx.empty(spark), spec).count() == 0


def test_bpe_slices_hold_whole_rows():
    from winnow.llm import bpe

    big = bpe.TRIE_CHARS
    for lengths in ([], [0], [5, big, 5], [big // 2] * 5, [3 * big], [0, 0, big + 1, 0]):
        cut = list(bpe._slices(lengths))
        assert [i for s, n in cut for i in range(s, s + n)] == list(range(len(lengths)))
        assert all(n == 1 or sum(lengths[s:s + n]) <= big for s, n in cut)


def test_bpe_fuzz_and_forgetting(monkeypatch):
    import random

    from tokenizers import Tokenizer
    from winnow.llm import bpe
    from winnow.llm.queries import byte_bpe_path

    path = byte_bpe_path()
    tok, enc = Tokenizer.from_file(path), bpe.TrieEncoder(open(path, encoding="utf-8").read())
    monkeypatch.setattr(bpe, "KEEP_WORDS", 50)
    monkeypatch.setattr(bpe, "KEEP_PAIRS", 50)
    monkeypatch.setattr(bpe, "KEEP_WORD", 5)
    rng = random.Random(11)
    pool = [chr(c) for c in range(0x180)] + list("̀٠ 　中​﻿\U0001f600") + ["<|endoftext|>", "'s", "the", "ing", " un", "  "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(3000)]
    for at in range(0, 3000, 300):
        part = texts[at:at + 300]
        assert [x.tolist() for x in enc.encode_texts(part)] == [tok.encode(t, add_special_tokens=False).ids for t in part]


def test_bpe_refuses_what_it_does_not_model():
    import json

    from winnow.llm import bpe
    from winnow.llm.queries import byte_bpe_path

    spec = json.loads(open(byte_bpe_path(), encoding="utf-8").read())
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}):
        with pytest.raises(ValueError):
            bpe.TrieEncoder(json.dumps(spec | change))


# ---------------------------------------------------------------- 9 HTML extraction

PAGE = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"


def test_blocks_of_awkward_markup():
    from winnow.llm.html_extract import blocks

    main = lambda h: [t for t, role in blocks(h) if role == "main"]
    assert blocks(None) == blocks("") == blocks("<p> &nbsp; </p>") == []
    assert main(PAGE + "<nav>Menu</nav><article><header><h1>A &amp; B</h1></header><p>one\n  two<p>three<br>four<aside>side</aside></article><footer>f") == ["A & B", "one two", "three four"]
    assert main("<main><p>a <b>b<br></p><!-- <p>no</p> --><p>c &lt;d&gt; &#233;&eacute</main>") == ["a b", "c <d> éé"]
    assert main("<article><p>x<span class='ad-slot'>buy</span> y</p><div id=comments><p>nice</p></div><form>mail</form><p>z</article>") == ["x y", "z"]
    assert main("<article><p>kept</p><p>cut <a href=\"/x") == ["kept", "cut"]
    assert main("<article class=comment>me too</article><article class='post'>a<article class=comment>no</article>b</article>") == ["a", "b"]
    assert [t for t, r in blocks("<div>u</div><div class=cookie-notice>we</div><p>1 < 2 &") if r == "open"] == ["u", "1 < 2 &"]
    assert main("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == ["deep"]


def test_names_of_wrappers_headings_and_anchors_lose_no_text(spark):
    from winnow.llm.html_extract import blocks, extract_main_text

    main = lambda h: [t for t, role in blocks(h) if role == "main"]
    kept = lambda h: [t for t, role in blocks(h) if role != "marked"]
    assert main("<div class='site has-sidebar'><article class='post has-comments'><h2 id='related-work'>Work</h2><section id='search'><p class='notice'>one"
                "</section></article><div class=sidebar>side</div></div>") == ["Work", "one"]
    assert main("<div class='widget'>w<article><p>a</article>x</div><p>y") == ["a"]
    assert main("<div class=sidebar><aside><article>teaser</article></aside></div><main><p>m<nav>n</nav></main>") == ["m"]
    assert kept("<div class='site has-sidebar'><p>text</p><div class='ad-slot'>ad</div><div id='comments'>c</div></div>") == ["text"]
    pages = [(0, "http://a/0", "<div id=content-form class=widget><p>words of one page alone, in a wrapper with a poor name</p><nav>n</nav></div>"),
             (1, "http://a/1", "<div class=widget><p>the second page has words of its own too</p></div>"), (2, "http://a/2", "<nav>n</nav>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert [r["__text"] for r in extract_main_text(df).orderBy("page_id").collect()] == [
        "words of one page alone, in a wrapper with a poor name", "the second page has words of its own too", ""]


def brute_extract(pages, run=5, covered=0.8):
    """All pairs of pages of a host, all common runs of words."""
    from winnow.llm.html_extract import blocks

    host = lambda u: (u or "").split("/")[2].lower() if "://" in (u or "") else ""
    cut = lambda t: [tuple(t.split(" ")[i:i + run]) for i in range(max(1, len(t.split(" ")) - run + 1))]
    runs = collections.defaultdict(set)
    for u, h in pages:
        for t, role in blocks(h):
            if role != "main":
                for x in cut(t):
                    runs[host(u), x].add(h)
    out = []
    for u, h in pages:
        kept, every = [], []
        for t, role in blocks(h):
            if role == "marked":
                continue
            every.append(t)
            n, mark = len(t.split(" ")), set()
            for i, x in enumerate(cut(t)):
                if len(runs[host(u), x]) > 1:
                    mark.update(range(i, min(n, i + run)))
            if role == "main" or len(mark) < covered * n:
                kept.append(t)
        out.append("\n".join(kept or every))
    return out


def test_extraction_matches_brute_force(spark):
    from winnow.llm.html_extract import extract_main_text

    note = "<div>Read our terms before you go on with this site today</div>"
    shared = "<p>a passage that both of these articles quote in full and rightly so</p>"
    pages = [("http://h.example/1", PAGE + note + "<article>" + shared + "<p>one</article>"),
             ("http://h.example/2", PAGE + note + "<article>" + shared + "<p>two</article>"),
             ("http://h.example/3", note + "<p>no article element on this page but text of its own kind</p><div>Home</div>"),
             ("https://h.example/4", "<div>Home</div><p>Read our terms before you go on with this site today and something more that is only here, in many words</p>"),
             ("http://other.example/1", note + "<p>alone</p>"), ("http://h.example/5", "<p>a page that is there twice word for word</p>"),
             ("http://H.example/6", "<p>a page that is there twice word for word</p>"), ("http://h.example/7", "<p>a page that is there twice word for word </p>"),
             (None, note), (None, None), ("not a url", ""), ("http://h.example/8", PAGE + "<article>" + "long text " * 20000)]
    pages.append(pages[2])
    df = spark.createDataFrame([(i, u, h, "x", 1, 2) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, host string, key long, block int")
    got = extract_main_text(df)
    rows = {r.page_id: r["__text"] for r in got.collect()}
    want = brute_extract(pages)
    assert [rows[i] for i in range(len(pages))] == want
    assert rows[0] == "a passage that both of these articles quote in full and rightly so\none"  # the notice goes, the quote stays
    assert rows[2] == "no article element on this page but text of its own kind"
    assert extract_main_text(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 10 nearest neighbours

def brute_nearest(vectors, asks, k):
    ids, x = [i for i, _ in vectors], np.array([v for _, v in vectors])
    out = {}
    for i in asks:
        q = x[ids.index(i)]
        score = (x * q).sum(1)
        out[i] = [(ids[j], score[j]) for j in sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-score[j], ids[j]))[:k]]
    return out


def test_ann_small_and_awkward(spark):
    from winnow.llm.ann import nearest

    rng = np.random.default_rng(4)
    good = [(i, [float(x) for x in np.float32(rng.normal(size=8) * (1 + i % 5))]) for i in range(150)]
    good += [(200 + i, good[20][1]) for i in range(60)] + [(1000, good[7][1])]  # a large class of equal vectors
    bad = [(300, None), (301, [0.0] * 8), (302, [None] + [1.0] * 7), (303, [float("nan")] * 8), (304, [float("inf")] + [1.0] * 7), (305, []), (306, [1.0] * 5), (None, [1.0] * 8), (320, [0.0] * 8)]
    df = spark.createDataFrame([(i, v, 1, 1) for i, v in good + bad], "vec_id long, embedding array<float>, rank int, score int")
    asks = [i for i, _ in good if i % 20 == 0]
    got = collections.defaultdict(list)
    for r in nearest(df, F.col("vec_id") % 20 == 0, 20, shard_rows=64).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    want = brute_nearest(good, asks, 20)
    assert sorted(got) == asks
    for i in asks:
        assert [r for r, _, _ in got[i]] == list(range(1, 21))
        assert [v for _, v, _ in got[i]] == [v for v, _ in want[i]]
        assert np.allclose([s for _, _, s in got[i]], [s for _, s in want[i]], atol=1e-12)
    few = nearest(df.filter("vec_id < 5"), F.col("vec_id") == 2, 20).collect()
    assert sorted(r.vec_id for r in few) == [0, 1, 3, 4]
    assert nearest(df.limit(0), F.lit(True)).count() == 0
    assert nearest(df.filter("vec_id = 301"), F.lit(True)).count() == 0


def test_ann_repeated_ids_and_lengths(spark):
    """An id may stand for several vectors, and vectors of other lengths are searched among their own."""
    from winnow.llm.ann import nearest

    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (5, [0.0, 1.0]), (20, [0.0, 2.0]), (100, [1.0, 2.0, 3.0]), (101, [3.0, 2.0, 1.0]), (102, [1.0, 0.0, 0.0]), (103, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(df, F.col("vec_id").isin(20, 100, 103), 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got.pop(20)) == [(1, 0, 2.0), (2, 5, 2.0), (3, 0, 0.0)]
    assert sorted(got.pop(100)) == [(1, 101, 10.0), (2, 102, 1.0)]
    assert not got  # the only vector of its length has nobody to meet


def test_ann_recall_over_shards_and_lanes(spark, monkeypatch):
    from winnow.llm import ann

    monkeypatch.setattr(ann, "QUERY_BLOCK", 50)
    monkeypatch.setattr(ann, "LANE_BLOCKS", 2)
    rng = np.random.default_rng(6)
    x = np.float32(rng.normal(size=(10000, 16)))
    x[7000:] = x[:3000] + 0.05 * np.float32(rng.normal(size=(3000, 16)))  # near copies
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(8)
    got = collections.defaultdict(set)
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0, 20, shard_rows=1500).collect():
        got[r.query_id].add(r.vec_id)
    hit, y = 0, x.astype(float)
    for i in range(0, 10000, 50):
        s = y @ y[i]
        s[i] = -np.inf
        hit += len(set(np.argsort(-s, kind="stable")[:20].tolist()) & got[i])
    assert len(got) == 200 and hit >= 0.95 * 20 * 200


def test_ann_recall_on_the_given_vectors(spark):
    import __spark_entry__ as e

    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    got = e.queries()["op10_graph_ann"](spark, sf).toPandas().groupby("query_id")["vec_id"].agg(set)
    hit = 0
    for at in np.flatnonzero(ids % 20 == 0):
        s = x @ x[at]
        s[at] = -np.inf
        hit += len(set(ids[np.argsort(-s, kind="stable")[:20]]) & got[ids[at]])
    assert hit >= 0.95 * 20 * len(got)


# ---------------------------------------------------------------- queries

def test_contract_columns(spark):
    import __spark_entry__ as e

    want = {"op1_": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
            "op3_": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
            "op4_": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
            "op5_": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
            "op7_": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
            "op8_": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
            "op9_": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
            "op10_": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
            "op11_": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
            "op12_": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
            "op13_": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"}}
    queries = e.queries()
    for prefix, types in want.items():
        (name,) = [q for q in queries if q.startswith(prefix)]
        df = queries[name](spark, SF)
        assert dict(df.dtypes) == types, name
        assert df.count() > 0
    assert len([q for q in queries if q.startswith("op")]) == 13
