"""Session helpers: one place for the Spark settings this engine relies on."""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "winnow",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks.  On a cluster, the cluster's
    own session is used as is; only unset options are filled in."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is
    used as is.  Only when it is unset on one machine (local tests) a scratch
    folder is created; on a cluster that is an error.  Lineage is always cut with reliable ``checkpoint()``, never
    ``localCheckpoint()``, so a lost executor does not lose state.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    one_machine = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    if not conf_dir and not one_machine:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not conf_dir:
        # one machine, no shared folder configured
        conf_dir = tempfile.mkdtemp(prefix="winnow-ckpt-", dir=os.environ.get("WINNOW_SCRATCH", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint directory for written tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    for t in TABLES:
        read_table(spark, sf_dir, t).createOrReplaceTempView(t)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``winnow`` importable in Python workers (pandas UDF kernels
    reference its functions): zip the package once and ``addPyFile`` it,
    which distributes it to every executor through the driver."""
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="winnow-pkg-"), "winnow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def spread(df: DataFrame) -> DataFrame:
    """Spread CPU-heavy per-row work over all cores when the input has fewer
    splits than the cluster has task slots (e.g. a single-row-group file).
    On large inputs (more splits than slots) this is a no-op: no shuffle."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots)


#: Rows of a partition of ``partitions_for``.
PARTITION_ROWS = 500_000


def partitions_for(df: DataFrame) -> int:
    """A number of partitions that grows with the rows of ``df``, so that a task's share does not.
    At least the session's number; of a plain table the count comes from its footers."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / PARTITION_ROWS))
