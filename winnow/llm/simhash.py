"""SimHash near-duplicates of whole documents with pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, same, shuffled, written
from .components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
#: XXH64 seed of a shingle.
SEED = 42
#: Shingles hashed at a time; bounds the memory a very long text takes.
BLOCK = 1 << 15


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash (unsigned) of the ASCII-lower-cased text's word shingles, repeats
    included: a bit is 1 if it is set in over half of the shingles' hashes.  Fewer words
    than a shingle: the whole sequence is one shingle; no word (null, empty, blank): 0."""
    from xxhash import xxh64_intdigest

    # bytes.lower() maps A-Z only and bytes.split() splits at \x20 and \x09-\x0D only
    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, BLOCK):
        part = w[at:at + BLOCK + words - 1] if len(w) >= words else w
        shingles = zip(*[part[i:] for i in range(words)]) if len(w) >= words else [part]
        h = np.array([xxh64_intdigest(b" ".join(s), SEED) for s in shingles], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            got = np.fromiter((fingerprint(t, words) for t in s), dtype=np.uint64, count=len(s))
            yield pd.Series(got.view(np.int64))

    return fp(text)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of ``max_bits + 2`` segments of 64 bits: within ``max_bits``
    differing bits, at least two segments are equal."""
    m = max_bits + 2
    edges = [round(i * 64 / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segment(fp: Column, seg: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(fp, seg[0]).bitwiseAND(F.lit((1 << seg[1]) - 1))


def pigeonring(differing: Column, max_bits: int, chain: int | None = None) -> Column:
    """Does the ring of segments hold a chain of ``chain`` consecutive segments all of whose
    prefixes keep within their share ``length * max_bits / segments`` of the budget?

    Every pair within ``max_bits`` has such a chain of any length up to the whole ring, so the
    test never drops a true pair.  ``differing`` is the XOR of two fingerprints."""
    segs = segments(max_bits)
    m = len(segs)
    chain = chain or m - 1
    diff = [F.bit_count(_segment(differing, s)) for s in segs]
    found = F.lit(False)
    for start in range(m):
        ok, total = F.lit(True), F.lit(0)
        for length in range(1, chain + 1):
            total = total + diff[(start + length - 1) % m]
            ok = ok & (total <= length * max_bits // m)
        found = found | ok
    return found


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: every pair of distinct fingerprints within ``max_bits`` bits, once.

    Each fingerprint is dealt by each pair of its ``max_bits + 2`` segments (a key of 21
    bits for 4); two fingerprints within the limit share at least one.  A candidate counts
    under the first key it shares only, must hold a pigeonring chain, and then passes the
    full Hamming check, all inside the join condition, so that candidates are not written.
    Both join sides are plain shuffles of a written table: a heavy key can be split.
    """
    segs = segments(max_bits)
    ways = list(combinations(range(len(segs)), 2))
    shift = max(w for _, w in segs)
    keys = F.array(*[
        F.struct(F.lit(k).alias("way"),
                 F.shiftleft(_segment(F.col("fp"), segs[i]), shift).bitwiseOR(_segment(F.col("fp"), segs[j])).alias("key"))
        for k, (i, j) in enumerate(ways)])
    dealt = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.way", "k.key")
    left = dealt.select(F.col("fp").alias("a"), F.col("way").alias("wa"), F.col("key").alias("ka"))
    right = dealt.select(F.col("fp").alias("b"), F.col("way").alias("wb"), F.col("key").alias("kb"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    equal = [_segment(differing, s) == 0 for s in segs]
    first = F.coalesce(*[F.when(equal[i] & equal[j], F.lit(k)) for k, (i, j) in enumerate(ways)])
    on = ((F.col("wa") == F.col("wb")) & (F.col("ka") == F.col("kb")) & (F.col("a") < F.col("b"))
          & (F.bit_count(differing) <= max_bits) & pigeonring(differing, max_bits) & (first == F.col("wa")))
    return left.join(right, on).select("a", "b")


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SHINGLE_WORDS,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (signed long), component_id, key, n_same of every row of ``docs``.

    Rows with equal fingerprints are one node, so that exact copies add no pairs; nodes
    within ``max_bits`` bits are linked; ``component_id`` is the smallest id reachable.
    Texts without words have fingerprint 0 and are linked like any other.  Null ids take
    part but name no component (one of null ids alone has a null ``component_id``).
    ``key`` is the row's key and ``n_same`` the rows that share id and key.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), row_key(docs).alias("key"),
                       fingerprints(F.col(f"`{text}`"), words).alias("fp"))
    rows = written(rows, "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp-nodes")
    comp = connected_components(near_pairs(nodes.select("fp"), max_bits))
    roots = nodes.join(comp, nodes["fp"] == comp["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    roots = written(roots, "fp-roots")
    names = roots.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "r")
    named = written(roots.join(names, roots["root"] == names["r"]).select(
        F.col("fp").alias("node_fp"), "component_id", "root"), "fp-names")
    return rows.join(named, rows["fp"] == named["node_fp"]).select("doc_id", "key", "fp", "component_id", "root")


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with the
    smallest id stays (without ids: the row with the smallest key).  Of rows that repeat
    the kept id, the one with the smallest key stays; fully equal rows count as one."""
    groups = simhash_groups(docs, text=text, doc_id=doc_id, **options)
    # min() keeps a row per group and task: a large group is not gathered anywhere
    kept = groups.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("k"))
    chosen = kept.select("root", F.col("k.doc_id").alias("__id"), F.col("k.key").alias("__key"))
    same_rows = groups.join(chosen.withColumnRenamed("root", "r"),
                            (F.col("root") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")))
    chosen = written(same_rows.groupBy("__id", "__key").agg(F.count(F.lit(1)).alias("__rows")), "kept")
    keyed = docs.withColumn("__row", row_key(docs))
    j = keyed.join(shuffled(chosen), same([F.col(f"`{doc_id}`"), F.col("__row")], [F.col("__id"), F.col("__key")]))
    names = [F.col(f"`{c}`") for c in docs.columns]
    single = j.filter("__rows = 1").select(*names)
    repeated = j.filter("__rows > 1").dropDuplicates(["__id", "__key"]).select(*names)
    return single.unionByName(repeated)
