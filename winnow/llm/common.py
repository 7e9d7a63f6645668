"""Helpers shared by the operators: written intermediate tables, gapless ranks,
row keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: ASCII white space as the contracts name it: space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder and Python package, for callers outside the query registry."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


#: The files of the tables written inside each open ``scratch``.
_OPEN: ContextVar[tuple[list, ...]] = ContextVar("_OPEN", default=())


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that ``written`` makes inside go at the end, other than ``lasting`` ones: for steps whose
    result is written too, so that their tables do not take up disk for the rest of the application."""
    paths: list = []
    token = _OPEN.set((*_OPEN.get(), paths))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for fs, path in paths:
            fs.delete(path, True)


def written(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder that ``spark.checkpoint.dir``
    names and read it back.

    Cuts the lineage (a lost executor costs no recomputation of earlier steps),
    fixes values that depend on the partitioning, and gives the planner the true
    size, so that it broadcasts only what is small.  The files go when the
    application ends, or with the ``scratch`` around; a ``lasting`` table outlives the
    innermost one.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/winnow-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.deleteOnExit(jpath)
    if around := _OPEN.get()[:-1] if lasting else _OPEN.get():
        around[-1].append((fs, jpath))
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(left: list[Column], right: list[Column]) -> Column:
    """Null-safe equality of two column lists."""
    cond = F.lit(True)
    for a, b in zip(left, right, strict=True):
        cond = cond & a.eqNullSafe(b)
    return cond


def shuffled(df: DataFrame) -> DataFrame:
    """A join side that grows with the corpus: the join is by shuffle at every size.  Else a
    small input would broadcast it, and what is measured on small inputs would not carry over."""
    return df.hint("merge")


def row_key(df: DataFrame) -> Column:
    """A 64-bit key of all columns of a row (columns of types that cannot be hashed are left out)."""
    usable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000null")) if df.schema[c].dataType.simpleString() in ("string", "bigint", "int") else F.col(f"`{c}`") for c in usable])


def gapless_rank(df: DataFrame, group: list[str], order: list[Column], out: str) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... within each ``group`` in ``order``, without one task per group.

    Rows are dealt by ranges of (group, order), so a group that holds a third of
    all rows spans a third of the partitions.  Each partition counts its rows per
    group; running sums of those counts (one row per partition and group) are the
    offsets added to a row number within (partition, group).
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(partitions(spark), *[F.col(g) for g in group], *order)
    dealt = written(dealt.withColumn("__part", F.spark_partition_id()), "ranked")
    counts = dealt.groupBy("__part", *group).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("__part").alias("__opart"), *[F.col(g).alias(f"__o_{g}") for g in group],
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    offsets = written(offsets, "rank-offsets")
    local = F.row_number().over(Window.partitionBy("__part", *group).orderBy(*order))
    joined = dealt.withColumn("__local", local).join(
        offsets,
        (F.col("__part") == F.col("__opart")) & same([F.col(g) for g in group], [F.col(f"__o_{g}") for g in group]))
    return joined.select(*df.columns, (F.col("__offset") + F.col("__local") - 1).cast("long").alias(out))


def uniform(*parts: Column | str) -> Column:
    """A reproducible number in [0, 1) from the MD5 of the parts joined by '|':
    the first 13 hex digits over 2^52.  Every SQL engine can compute the same."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    digest = F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(4503599627370496.0)
