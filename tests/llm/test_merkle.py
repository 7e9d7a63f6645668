"""Merkle manifest against brute force, level by level, on awkward rows and small blocks."""

import collections
import hashlib
import os
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fixtures_llm as fx  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(*values):
    texts = [None if v is None else str(v) for v in values]
    return sha("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def climb(level):
    """Root of a list of nodes and each one's siblings with their sides."""
    paths = [[] for _ in level]
    at = list(range(len(level)))
    while len(level) > 1:
        for k, i in enumerate(at):
            j = i ^ 1
            paths[k].append("" if j >= len(level) else ("L" if i % 2 else "R") + level[j])
        level = [sha("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root of the changed leaf) of rows (doc_id, source, lang, n_chars, text)."""
    by = collections.defaultdict(list)
    for d, s, la, n, t in rows:
        changed = d is not None and zlib.crc32(str(d).encode()) % 7 == 0 and n is not None
        by[la].append((d, leaf_of(d, s, la, n, t), leaf_of(d, s, la, n + 1, t) if changed else leaf_of(d, s, la, n, t)))
    names = sorted(by, key=lambda la: (la is not None, (la or "").encode()))
    trees = {}
    for la in names:
        by[la].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[la] = climb([r[1] for r in by[la]])
    root, tops = climb([trees[la][0] for la in names])
    out = []
    for la, top in zip(names, tops):
        for (d, leaf, seen), path in zip(by[la], trees[la][1]):
            folded, whole = seen, path + top
            for p in whole:
                folded = sha(p[1:] + folded if p[:1] == "L" else folded + p[1:])
            out.append((d, leaf, trees[la][0], root, sha("".join(p[1:] for p in whole)), folded, folded == root))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 9, 21, 64, 65])
def test_positions_address_the_log(n):
    from winnow.llm.merkle import append_log, paths, position
    import numpy as np

    leaves = [sha(str(i)) for i in range(n)]
    height = (n - 1).bit_length()
    for extra in (0, 2):  # also as a block that is raised to the height of full ones
        log = append_log(leaves, height + extra)
        level, nodes = 0, leaves
        seen = []
        while level <= height + extra:
            at = position(level, np.arange(len(nodes)), n)
            assert [log[i] for i in at] == nodes
            seen += at.tolist()
            nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
            level += 1
        assert sorted(seen) == list(range(len(log)))
    root, want = climb(leaves)
    assert append_log(leaves, height)[-1] == root
    assert paths(append_log(leaves, height), n, height, np.arange(n)) == want


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_proofs_match_brute_force(spark, levels):
    from winnow.llm import merkle

    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in fx.rows()] + [(i, "s", "it", None if i % 5 else 3, "") for i in range(100, 137)] \
        + [(1, "s", "", 0, ""), (2, "s", "é", 0, "")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, rank int, tree string")
    fields = lambda n: merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    leaves = df.select("doc_id", "lang", fields(F.col("n_chars")).alias("leaf"), F.when(tampered, fields(F.col("n_chars") + 1)).alias("changed"))
    got = merkle.inclusion_proofs(leaves, "lang", [F.col("doc_id")], levels=levels)
    got = got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof"),
                     merkle.fold(F.coalesce("changed", "leaf"), F.col("path")).alias("folded"))
    got = got.withColumn("ok", F.col("folded") == F.col("root")).collect()
    want = brute(rows)
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert {r[6] for r in want} == {True, False}


def test_empty_table_one_row_and_clashing_names(spark):
    from winnow.llm import merkle

    schema = "leaf string, g string, rank long, tree string, block long, path string, log string"
    empty = spark.createDataFrame([], schema)
    clean = lambda df: df.select("leaf", "g")
    assert merkle.inclusion_proofs(clean(empty), "g", []).count() == 0
    one = merkle.inclusion_proofs(clean(spark.createDataFrame([("ab", None, 1, "t", 1, "p", "l")], schema)), "g", []).first()
    assert (one.subroot, one.root, one.path) == ("ab", "ab", [])


def test_registered_query_on_the_smallest_table(spark):
    from winnow.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op12_merkle_manifest"](spark, sf).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute(rows))
