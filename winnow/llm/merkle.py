"""Merkle manifest of a dataset: one tree per group in postorder append logs, a tree over the
groups, inclusion proofs addressed by closed-form positions."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank, written

#: Levels of an aligned block: one builder appends the nodes over 2^BLOCK_LEVELS leaves.
BLOCK_LEVELS = 10
_PROVEN = "path array<string>, subroot string, root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count of the value's text, a colon and the text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path (see ``inclusion_proofs``) lead to."""
    def step(own: Column, entry: Column) -> Column:
        other = F.substring(entry, 2, 64)
        return F.sha2(F.when(F.left(entry, F.lit(1)) == "L", F.concat(other, own)).otherwise(F.concat(own, other)), 256)

    return F.aggregate(path, leaf, step)


def proof_digest(path: Column) -> Column:
    """Digest of the siblings of a path, joined from the leaf to the root."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda entry: F.substring(entry, 2, 64))), 256)


def append_log(leaves: list[str], height: int) -> list[str]:
    """All nodes over the leaves in the order of their completion; the last is at ``height``.

    A pair's parent follows its right child at once.  When the leaves end, what stands open is
    closed from below: a node without a right sibling becomes the only child of its parent.
    """
    log: list[str] = []
    waiting: list[tuple[int, str]] = []
    level, node = 0, ""
    for node in leaves:
        level = 0
        log.append(node)
        while waiting and waiting[-1][0] == level:
            node = digest(waiting.pop()[1] + node)
            level += 1
            log.append(node)
        waiting.append((level, node))
    waiting.pop()
    while level < height:
        left = waiting.pop()[1] if waiting and waiting[-1][0] == level else ""
        node = digest(left + node)
        level += 1
        log.append(node)
    return log


def position(level: int, index: np.ndarray, leaves: int) -> np.ndarray:
    """Place in the log of the nodes ``index`` of a level, over so many leaves.

    m leaves have 2m - popcount(m) nodes of full subtrees.  A full node follows its last leaf
    by as many places as its level; of the others each level above the lowest set bit of
    ``leaves`` has one, and they end the log in the order of their levels.
    """
    last = ((index + 1) << level) - 1
    full = 2 * last - np.bitwise_count(last).astype(np.int64) + level
    low_bit = (leaves & -leaves).bit_length() - 1
    return np.where(last < leaves, full, 2 * leaves - leaves.bit_count() + level - 1 - low_bit)


def paths(log: list[str], leaves: int, height: int, index: np.ndarray) -> list[list[str]]:
    """Path of each leaf ``index`` to the log's last node: a level's sibling, ``L`` or ``R``
    before it for its side, or an empty entry where a node has none."""
    nodes, levels = np.array([*log, ""], dtype=object), []
    for level in range(height):
        here = index >> level
        other = here ^ 1
        there = other < -(-leaves // (1 << level))
        at = np.where(there, position(level, other, leaves), len(log))
        levels.append(np.where(there, np.where(here & 1, "L", "R"), "").astype(object) + nodes[at])
    return [list(p) for p in zip(*levels)] if levels else [[] for _ in index]


def _append(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("rank")
    n, block = len(pdf), int(pdf["block"].iloc[0])
    # blocks are filled in order, so one that is not full and the first is the only one
    levels = int(pdf["levels"].iloc[0])
    height = levels if block else min(levels, (n - 1).bit_length())
    log = append_log(pdf["digest"].tolist(), height)
    return pd.DataFrame({"tree": pdf["tree"].iloc[:1], "block": [block], "leaves": [n], "height": [height], "log": [log]})


def build_logs(nodes: DataFrame, levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """The written logs (tree, block, leaves, height, log) of all trees, lowest levels first.

    ``nodes`` has (tree, rank, digest), ranks gapless from 0 in each tree.  An aligned run of
    2^levels nodes is one builder's group, whatever the size of a tree; the tops of the runs
    are the nodes of the next log, until each tree has one.
    """
    logs = []
    while True:
        runs = nodes.select("tree", "rank", "digest", F.shiftright("rank", levels).alias("block"), F.lit(levels).alias("levels"))
        log = runs.groupBy("tree", "block").applyInPandas(_append, "tree string, block long, leaves int, height int, log array<string>")
        logs.append(written(log, f"merkle-log-{len(logs)}"))
        if not logs[-1].agg(F.max("block")).first()[0]:
            return logs
        nodes = logs[-1].select("tree", F.col("block").alias("rank"), F.element_at("log", -1).alias("digest"))


def _extract(schema_names: list[str]):
    def extract(nodes: pd.DataFrame, log: pd.DataFrame) -> pd.DataFrame:
        entry = log.iloc[0]
        index = nodes["rank"].to_numpy(dtype=np.int64) - (int(entry["block"]) << int(entry["levels"]))
        upper = list(entry["path"])
        nodes["path"] = [p + upper for p in paths(list(entry["log"]), int(entry["leaves"]), int(entry["height"]), index)]
        nodes["subroot"], nodes["root"] = entry["subroot"], entry["root"]
        return nodes[schema_names]

    return extract


def extract_proofs(nodes: DataFrame, logs: list[DataFrame], above: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """``nodes`` (tree, rank, ...) with path, subroot and root.  ``above`` has (tree, path, subroot,
    root): what leads on from each tree's last node.  The logs are read from the top; a row
    of ``nodes`` moves once, to the log of its block."""
    upper = above.select("tree", F.lit(0).cast("long").alias("up"), "path", "subroot", "root")
    for i in reversed(range(len(logs))):
        log = logs[i].select(F.col("tree").alias("t"), "block", "leaves", "height", "log")
        with_upper = log.join(upper, (F.col("t") == F.col("tree")) & (F.col("block") == F.col("up"))).select(
            "tree", "block", "leaves", "height", "log", "path", "subroot", "root", F.lit(levels).alias("levels"))
        rows = nodes if i == 0 else logs[i - 1].select("tree", F.col("block").alias("rank"))
        names = [*rows.columns, "path", "subroot", "root"]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", " + _PROVEN
        keyed = rows.withColumn("__block", F.shiftright("rank", levels))
        proven = keyed.groupBy("tree", "__block").cogroup(with_upper.groupBy("tree", "block")).applyInPandas(_extract(names), schema)
        if i:
            upper = written(proven.select("tree", F.col("rank").alias("up"), "path", "subroot", "root"), f"merkle-paths-{i}")
    return proven


def inclusion_proofs(leaves: DataFrame, group: str, order: list[Column], leaf: str = "leaf", levels: int = BLOCK_LEVELS) -> DataFrame:
    """``leaves`` with path, subroot and root.

    The rows of a ``group`` (text, null one of its own) in ``order``, ties by their digests,
    are the leaves of its tree; every two nodes of a level become their digest, a lone last one
    becomes its own digest.  The groups' last nodes, null first and then by UTF-8 bytes, are the
    leaves of a tree likewise, whose last node is the root.  A path has an entry for each level
    from the leaf to the root: ``L`` or ``R``, the sibling's side, before the sibling's digest, or nothing
    where there is none.  A path of a lone leaf is empty.  Equal rows have places of their
    own.  An empty table gives an empty one.
    """
    names = leaves.columns
    # null becomes the empty name, any other gets a sign before it: the bytes keep their order
    own = written(leaves.withColumn("tree", F.coalesce(F.concat(F.lit("+"), F.col(group)), F.lit(""))), "merkle-leaves")
    ranked = gapless_rank(own, ["tree"], [*order, F.col(leaf)], "rank")
    ranked = written(ranked, "merkle-ranked")
    logs = build_logs(ranked.select("tree", "rank", F.col(leaf).alias("digest")), levels)
    tops = logs[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.element_at("log", -1).alias("digest"))
    groups = written(gapless_rank(tops, ["tree"], [F.col("name")], "rank"), "merkle-groups")
    group_logs = build_logs(groups, levels)
    root = group_logs[-1].select("tree", F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"),
                                 F.element_at("log", -1).alias("root"))
    above = extract_proofs(groups.select("tree", "rank", "name", "digest"), group_logs, root, levels)
    above = written(above.select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "merkle-above")
    proven = extract_proofs(ranked.select("tree", "rank", *names), logs, above, levels)
    return proven.select(*names, "path", "subroot", "root")
