"""String helpers: prompt rendering, non-blank rule, model identity,
bounded text, identifiers (B1, B9, B12, B14, B15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import codes


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(x) -> Column:
    """Unicode-aware trim (Python ``str.strip`` semantics for whitespace)."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def non_blank(x) -> Column:
    """A string that is non-empty after trimming."""
    return _c(x).isNotNull() & (F.length(trimmed(x)) > 0)


def render_message(role, content) -> Column:
    return F.concat(F.lit("<"), _c(role), F.lit(">\n"), _c(content), F.lit("\n</"), _c(role), F.lit(">"))


def render_prompt(prompt, messages) -> Column:
    """B1: the prompt as is, else the messages joined by newlines, each as
    ``<role>\\ncontent\\n</role>``.  ``messages`` is array<struct<role, content>>."""
    rendered = F.array_join(F.transform(_c(messages), lambda m: render_message(m["role"], m["content"])), "\n")
    return F.coalesce(_c(prompt), rendered)


def render_turns(turns: DataFrame, key: str, order: str, role: str, content: str, out: str = "rendered") -> DataFrame:
    """B1 over a turn table: one rendered prompt per conversation.

    Partial aggregation collects (order, text) per key; the sort happens
    inside the array, so no window over a whole conversation is needed."""
    agg = turns.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), render_message(role, content).alias("t")))).alias("parts")
    )
    return agg.select(key, F.array_join(F.transform("parts", lambda p: p["t"]), "\n").alias(out))


def model_identity(m) -> Column:
    """Trimmed, without a trailing ``:latest``."""
    return F.regexp_replace(F.trim(_c(m)), r":latest$", "")


def bounded_text(x, limit: int, marker: str = codes.TRUNCATION_MARKER) -> Column:
    """Text of at most ``limit`` characters; cut text ends with the marker."""
    return F.when(F.length(_c(x)) > limit, F.concat(F.substring(_c(x), 1, limit - len(marker)), F.lit(marker))).otherwise(_c(x))


def format_id(prefix, counter) -> Column:
    """Prefix + counter zero-padded to at least 4 digits (width only grows)."""
    s = _c(counter).cast("string")
    return F.concat(_c(prefix) if not isinstance(prefix, str) else F.lit(prefix),
                    F.when(F.length(s) < 4, F.lpad(s, 4, "0")).otherwise(s))


def parse_id(i) -> Column:
    """B15 parse: struct(group, kind, counter) = [0:2], [2:4], [4:]."""
    return F.struct(
        F.substring(_c(i), 1, 2).alias("group"),
        F.substring(_c(i), 3, 2).alias("kind"),
        F.expr(f"substring({i}, 5)").cast("long").alias("counter") if isinstance(i, str)
        else F.substring(_c(i), 5, 1 << 30).cast("long").alias("counter"),
    )


def assign_ids(df: DataFrame, prefix: str, order_cols: list, start: int = 0, out: str = "id",
               n_parts: int | None = None) -> DataFrame:
    """B15 in bulk: consecutive counters from ``start`` in the given order.

    A global ``row_number`` would pull every row into one task.  Instead the
    rows are range-partitioned and sorted inside each partition; the rank in
    a partition comes from ``monotonically_increasing_id`` (no shuffle), the
    per-partition counts become offsets (one small row per partition).  The
    numbered frame is checkpointed so both uses see the same partitioning."""
    spark = df.sparkSession
    n_parts = n_parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = (
        df.repartitionByRange(n_parts, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    )
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")
    )
    # one row per partition: bounded by the partition count
    out_df = ranged.join(F.broadcast(offsets), "_pid")
    return out_df.withColumn(out, format_id(prefix, F.col("_off") + F.col("_local") + F.lit(start))).drop("_pid", "_local", "_off")
