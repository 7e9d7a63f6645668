"""The store: tables of committed parts with first-write-wins appends
(A3, A4, A5, A6, D8).

"Insert if absent" is an anti join against the keys already stored, then a new
part.  A part is a folder of slices by key hash; beside it stand, for each
slice, a Bloom filter and the least and largest key.  An append first asks
these which slices can hold any of its keys, and reads the keys of those only.
A part becomes visible by its line in the commit list, written last, so that a
failed append leaves nothing.  A single writer per table is assumed (the
pipeline's stages run in order).  Reruns append nothing.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.text import trimmed

# table -> key used by first-write-wins (the parent the row hangs from)
TABLE_KEYS = {
    "model_registry": ["model_id"],
    "runs": ["run_id"],
    "tasks": ["task_id"],
    "generations": ["task_id"],
    "validation_results": ["generation_id"],
    "samples": ["generation_id"],
    "embeddings": ["source_type", "source_id"],
}
#: Rows of a slice (about), bits of its filter per row, and places that a key sets in it.
SLICE_ROWS, KEY_BITS, KEY_PLACES = 65_536, 20, 7


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _index_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/part_index/{table}"


def commits(spark: SparkSession, root: str, table: str) -> list[dict]:
    """The committed parts, one small line for each append: part, slices, rows, low, high."""
    try:
        lines = spark.read.text(f"{root.rstrip('/')}/part_commits/{table}").collect()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":  # a store that cannot be read is not an empty one
            raise
        return []
    return sorted((json.loads(r[0]) for r in lines), key=lambda c: c["part"])


def read_store(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """All rows of the committed parts; None if there are none."""
    path = table_path(root, table)
    parts = [f"{path}/_part={c['part']}" for c in commits(spark, root, table)]
    return spark.read.option("basePath", path).parquet(*parts).drop("_part", "_slice") if parts else None


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key, the first in ``order`` (a partial ``min_by``
    aggregate: a hot key does not gather in one task)."""
    packed = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order))
    return df.groupBy(*key).agg(packed.alias("_r")).select("_r.*")


def new_rows(incoming: DataFrame, existing: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet; a null key equals a null key."""
    if existing is None:
        return incoming
    held = existing.select(*[F.col(k).alias(f"_k_{k}") for k in key]).distinct()
    on = F.lit(True)
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return incoming.join(held, on, "left_anti")


def _key_text(key: Sequence[str]) -> Column:
    """A key as one text; a null part comes before every other."""
    return F.concat_ws("\u0001", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits that each hash sets, by double hashing."""
    h = hashes.astype(np.uint64)
    step = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33) | np.uint64(1)
    return (h[:, None] + step[:, None] * np.arange(KEY_PLACES, dtype=np.uint64)) % np.uint64(bits)


def _filter_of(pdf: pd.DataFrame) -> pd.DataFrame:
    bits = max(64, KEY_BITS * len(pdf))
    held = np.zeros(bits, dtype=bool)
    held[_places(pdf["_h"].to_numpy(dtype=np.int64), bits)] = True
    return pd.DataFrame({"_slice": pdf["_slice"].iloc[:1].to_numpy(), "bits": [bits], "low": [pdf["_k"].min()], "high": [pdf["_k"].max()],
                         "held": [np.packbits(held).tobytes()]})


def _may_hold(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """(part, slice) if any asked key may be in the slice."""
    hit = False
    if len(index) and len(asked):
        slice_ = index.iloc[0]
        inside = asked[(asked["_k"] >= slice_["low"]) & (asked["_k"] <= slice_["high"])]
        held = np.unpackbits(np.frombuffer(slice_["held"], dtype=np.uint8))
        hit = bool(len(inside)) and bool(held[_places(inside["_h"].to_numpy(dtype=np.int64), int(slice_["bits"]))].all(axis=1).any())
    return pd.DataFrame({"_part": index["_part"].iloc[:int(hit)].astype(object), "_slice": index["_slice"].iloc[:int(hit)].astype("int32")})


def slices_to_read(spark: SparkSession, incoming: DataFrame, root: str, table: str, key: Sequence[str]) -> tuple[list[tuple[str, int]], int]:
    """((part, slice) of all slices that may hold a key of ``incoming``, number of all slices).

    Parts whose range of keys the batch misses are left out by the commit list alone; each
    other slice's filter meets the batch's keys of its slice in a task of its own."""
    parts = commits(spark, root, table)
    total = sum(c["slices"] for c in parts)
    keys = incoming.select(F.xxhash64(*key).alias("_h"), _key_text(key).alias("_k"))
    low, high = keys.agg(F.min("_k"), F.max("_k")).first()
    # bytes of UTF-8 order as code points do, here and in Spark
    met = [] if low is None else [c for c in parts if c["low"] <= high and low <= c["high"]]
    if not met:
        return [], total
    listed = F.array(*[F.struct(F.lit(c["part"]).alias("p"), F.lit(c["slices"]).alias("n")) for c in met])
    asked = keys.distinct().withColumn("c", F.explode(listed)).select(
        F.col("c.p").alias("_part"), F.pmod("_h", F.col("c.n")).cast("int").alias("_slice"), "_h", "_k")
    path = _index_path(root, table)
    index = spark.read.option("basePath", path).parquet(*[f"{path}/_part={c['part']}" for c in met])
    hits = index.groupBy("_part", "_slice").cogroup(asked.groupBy("_part", "_slice")).applyInPandas(_may_hold, "_part string, _slice int").collect()
    return sorted((r[0], r[1]) for r in hits), total


def _stored_keys(spark: SparkSession, incoming: DataFrame, root: str, table: str, key: Sequence[str], more: Sequence[str] = ()) -> DataFrame | None:
    """Key columns (and ``more``) of the slices that may hold a key of ``incoming``."""
    found, _ = slices_to_read(spark, incoming, root, table, key)
    path = table_path(root, table)
    paths = [f"{path}/_part={p}/_slice={s}" for p, s in found]
    return spark.read.option("basePath", path).parquet(*paths).select(*key, *more) if paths else None


def _commit_part(spark: SparkSession, rows: DataFrame, root: str, table: str, key: Sequence[str], slices: int) -> DataFrame:
    """Write rows as a part with its index, then its line; the part as read back."""
    part, path = f"p{uuid.uuid4().hex}", table_path(root, table)
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(*key), F.lit(slices)).cast("int"))
    sliced.repartition("_slice").write.partitionBy("_slice").parquet(f"{path}/_part={part}")
    back = spark.read.schema(sliced.schema).option("basePath", f"{path}/_part={part}").parquet(f"{path}/_part={part}")
    keyed = back.select("_slice", F.xxhash64(*key).alias("_h"), _key_text(key).alias("_k"))
    # a stated number of partitions is kept: the few bytes of keys would else become one task
    index = keyed.repartition(slices, "_slice").groupBy("_slice").applyInPandas(_filter_of, "_slice int, bits long, low string, high string, held binary")
    index.write.parquet(f"{_index_path(root, table)}/_part={part}")
    n, low, high = keyed.agg(F.count(F.lit(1)), F.min("_k"), F.max("_k")).first()
    if n:
        line = json.dumps({"part": part, "slices": slices, "rows": n, "low": low, "high": high})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{root.rstrip('/')}/part_commits/{table}")
    return back.drop("_slice")


def append_once(spark: SparkSession, incoming: DataFrame, root: str, table: str,
                key: Sequence[str] | None = None, order: Sequence | None = None) -> DataFrame:
    """A4: first write wins, per key.  Within the batch the first row in
    ``order`` wins; a stored row always wins over the batch.  Returns the
    rows actually appended."""
    key = list(key or TABLE_KEYS[table])
    batch = first_per_key(incoming, key, order or [F.col(c) for c in key]) if order is not None else incoming.dropDuplicates(key)
    batch = batch.checkpoint(eager=True)  # the index is asked with the same rows that are appended
    stored = _stored_keys(spark, batch, root, table, key)
    existing = read_store(spark, root, table)
    fresh = new_rows(batch, stored, key)
    if existing is not None:
        fresh = fresh.select(*existing.columns)
    return _commit_part(spark, fresh, root, table, key, max(1, math.ceil(batch.count() / SLICE_ROWS)))


def append_embeddings_once(spark: SparkSession, incoming: DataFrame, root: str) -> DataFrame:
    """A4 (embeddings): a second vector for a generation with the same model
    is ignored; with another model it is an error, and nothing is appended."""
    key = ["source_type", "source_id"]
    stored = _stored_keys(spark, incoming, root, "embeddings", key, ["embedding_model_id"])
    if stored is not None:
        clash = incoming.alias("i").join(stored.alias("e"), key) \
            .filter(~F.col("i.embedding_model_id").eqNullSafe(F.col("e.embedding_model_id"))).limit(1).collect()
        if clash:
            raise ValueError(f"generation {clash[0]['source_id']} already has an embedding from another model")
    return append_once(spark, incoming, root, "embeddings", key, [F.col("embedding_id")])


def import_tasks_once(spark: SparkSession, incoming: DataFrame, root: str, order: Sequence) -> DataFrame:
    """A3: one task per (run_id, trimmed source_id); the first line wins
    within the batch, an existing task wins over the batch (its payload is kept)."""
    x = incoming.withColumn("source_id", trimmed("source_id"))
    return append_once(spark, x, root, "tasks", ["run_id", "source_id"], order)


def lookup(df: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """Key lookups as a semi join (never one call per row)."""
    return df.join(values.select(key).distinct(), key, "left_semi")
