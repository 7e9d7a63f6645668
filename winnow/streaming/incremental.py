"""Incremental selection (H8): pick up new task files, process each once,
continue after a stop.

A file-source stream feeds ``foreachBatch``.  Each micro-batch runs the verdict stage and
decides the greedy dedup of its rows against a state that is cut into buckets: ids already
judged, by buckets of the id, and the first row of each key so far, by buckets of the key.
Only the buckets that a batch touches are listed and read.

The first row of a key only ever gets earlier, so the state is a table of winners to which a
batch adds those it changes; the one in force is the least.  A late row that comes earlier in
queue order supersedes a winner: the batch adds a correction, and ``current_selection`` leads
every row that names a superseded winner to the one in force.  What a batch writes stands
under its number and is overwritten by a replay of the same batch, which reads earlier numbers
only: a batch takes effect once, wherever it was stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from ..functions import codes
from ..sources.store import first_per_key

#: Buckets of ids and of keys.
BUCKETS = 64


def read_buckets(spark: SparkSession, path: str, column: str, values: Sequence[int], before: int) -> DataFrame | None:
    """Rows of the given buckets that batches before ``before`` wrote; only these folders are listed."""
    if not values:
        return None
    try:
        held = spark.read.option("basePath", path).parquet(f"{path}/{column}={{{','.join(map(str, sorted(values)))}}}")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return held.filter(F.col("_epoch") < before)


def _touched(df: DataFrame, column: str) -> list[int]:
    """At most as many as there are buckets."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _write(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """One file per bucket; winners are one row per key, ids are dealt evenly."""
    df.repartition(by[0]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _same(keys: Sequence[str], prefix: str) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(prefix + k))
    return on


def judge_batch(rows: DataFrame, root: str, epoch: int, id_col: str, keys: Sequence[str], order: Sequence[Column],
                id_bucket: Column | None = None, buckets: int = BUCKETS) -> dict:
    """Decide one batch of verdict rows (``failure_code`` null: passed) and write its verdicts,
    changed winners and corrections.  An id that an earlier batch judged is left out (first
    write wins).  Returns how many buckets of ids and keys were read."""
    spark, keys = rows.sparkSession, list(keys)
    bucket = F.pmod(F.xxhash64(id_col), F.lit(buckets)) if id_bucket is None else id_bucket
    queue = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.col(id_col).alias("_id"))
    rows = first_per_key(rows, [id_col], [F.col(c) for c in rows.columns]).withColumns({"_idb": bucket.cast("int"), "_queue": queue}).checkpoint(eager=True)
    id_buckets = _touched(rows, "_idb")
    seen = read_buckets(spark, f"{root}/verdicts", "_idb", id_buckets, epoch)
    fresh = rows if seen is None else rows.join(seen.select(F.col(id_col).alias("_seen")), F.col(id_col) == F.col("_seen"), "left_anti")
    fresh = fresh.checkpoint(eager=True)

    mine = fresh.filter(F.col("failure_code").isNull()).groupBy(*keys).agg(F.min("_queue").alias("_first"))
    mine = mine.withColumn("_kb", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).checkpoint(eager=True)
    key_buckets = _touched(mine, "_kb")
    held = read_buckets(spark, f"{root}/winners", "_kb", key_buckets, epoch)
    if held is None:
        now = mine.withColumn("_old", F.lit(None).cast(mine.schema["_first"].dataType))
    else:
        old = held.groupBy(*keys).agg(F.min("_first").alias("_old")).withColumnsRenamed({k: f"_h_{k}" for k in keys})
        now = mine.join(old, _same(keys, "_h_"), "left").drop(*[f"_h_{k}" for k in keys])
    earlier = F.col("_old").isNull() | (F.col("_first") < F.col("_old"))
    now = now.withColumn("_new", earlier).withColumn("_now", F.when(earlier, F.col("_first")).otherwise(F.col("_old"))).checkpoint(eager=True)
    number = F.lit(epoch).cast("long").alias("_epoch")
    _write(now.filter("_new").select(*keys, "_first", "_kb", number), f"{root}/winners", ["_kb", "_epoch"])
    _write(now.filter(F.col("_new") & F.col("_old").isNotNull()).select(*keys, F.col("_old._id").alias("_superseded"), "_kb", number),
           f"{root}/corrections", ["_kb", "_epoch"])
    winner = now.select(*[F.col(k).alias(f"_w_{k}") for k in keys], F.col("_now._id").alias("_winner"))
    judged = fresh.join(winner, F.col("failure_code").isNull() & _same(keys, "_w_"), "left")
    judged = judged.withColumn("duplicate_of", F.when(F.col("_winner") != F.col(id_col), F.col("_winner")))
    _write(judged.drop("_queue", "_winner", *[f"_w_{k}" for k in keys]).withColumn("_epoch", number), f"{root}/verdicts", ["_idb", "_epoch"])
    return {"epoch": epoch, "id_buckets": len(id_buckets), "key_buckets": len(key_buckets)}


def current_selection(spark: SparkSession, root: str, id_col: str, keys: Sequence[str]) -> DataFrame:
    """The verdicts in force: columns of the stage, ``status``, ``failure_code``, ``duplicate_of``.

    Corrections and the winners of their keys are the only state that is joined."""
    keys = list(keys)
    verdicts = spark.read.parquet(f"{root}/verdicts").drop("_idb", "_epoch")
    try:
        gone = spark.read.parquet(f"{root}/corrections").select(*keys, "_superseded")
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        gone = None
    if gone is not None:
        winners = spark.read.parquet(f"{root}/winners").groupBy(*keys).agg(F.min("_first").alias("_f"))
        final = winners.select(*[F.col(k).alias(f"_w_{k}") for k in keys], F.col("_f._id").alias("_final"))
        moved = gone.join(final, _same(keys, "_w_")).select("_superseded", "_final").distinct()
        names = F.when(F.col("failure_code").isNull(), F.coalesce(F.col("duplicate_of"), F.col(id_col)))
        verdicts = verdicts.join(moved, names == F.col("_superseded"), "left").withColumn("duplicate_of", F.coalesce("_final", "duplicate_of"))
        verdicts = verdicts.drop("_superseded", "_final")
    code = F.coalesce(F.col("failure_code"), F.when(F.col("duplicate_of").isNotNull(), F.lit(codes.DUPLICATE_SAMPLE)))
    return verdicts.withColumn("failure_code", code).withColumn(
        "status", F.when(code.isNull(), F.lit(codes.ACCEPTED)).otherwise(F.lit(codes.REJECTED)))


def run_incremental(spark: SparkSession, source_dir: str, schema: StructType, stage: Callable[[DataFrame], DataFrame],
                    root: str, id_col: str, keys: Sequence[str], order: Sequence[Column], checkpoint: str,
                    max_files_per_trigger: int = 1, id_bucket: Column | None = None, buckets: int = BUCKETS) -> list[dict]:
    """Process every file in ``source_dir`` not yet processed, then stop (``availableNow``).
    ``stage`` maps a micro-batch to verdict rows with the id, the keys, what ``order`` needs and
    ``failure_code``.  Returns what each batch read."""
    read: list[dict] = []

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        read.append(judge_batch(stage(batch), root, epoch_id, id_col, keys, order, id_bucket, buckets))

    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)
         .writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"incremental selection failed: {err}")
    return read
