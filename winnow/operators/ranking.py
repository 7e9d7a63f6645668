"""Score-ranked selection (K7): the best rows of each dataset by a model's score.

No window runs over a dataset.  A mergeable quantile sketch per dataset brackets the score at
which the wanted rows end; rows above the bracket are in, rows below are out, and only
the rows inside are ranked exactly, by ranges of (dataset, score, id), so that a
dataset with a third of all rows, or one whose scores are all equal, is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Steps of the quantile grid, and the sketch's accuracy (its rank error is one row in so many).
GRID, ACCURACY = 256, 10_000


def range_rank(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """Adds ``out``: 1, 2, ... within each group in ``order``, without one task per group.

    Rows are dealt by ranges of (group, order); a row's place is the number of its group's rows
    in earlier ranges (one row per range and group) plus its place in its own range."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *[F.col(g) for g in group], *order).withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    counts = dealt.groupBy("_range", *group).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_range").alias("_at"), *[F.col(g).alias(f"_g_{g}") for g in group],
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order))
    on = F.col("_range") == F.col("_at")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    ranked = dealt.withColumn("_own", own).join(offsets, on)
    return ranked.select(*df.columns, (F.col("_own") + F.col("_before")).cast("long").alias(out))


def select_top(df: DataFrame, group: str, score: str, id_col: str, share: float | None = None, n: int | None = None) -> DataFrame:
    """``df`` with ``selected``: is the row among its dataset's best?

    Of each ``group`` (null is one) the ``n`` rows with the highest score, or the ``share`` of
    its scored rows (rounded up), are selected; equal scores by smaller id.  Rows without a score, or
    with NaN, are not selected and not counted.  Infinite scores are scores.
    """
    if (share is None) == (n is None):
        raise ValueError("give either a share or a number of rows")
    if share is not None and not 0 <= share <= 1 or n is not None and n < 0:
        raise ValueError("a share lies in 0 to 1, a number of rows is not negative")
    value = F.col(score).cast("double")
    scored = value.isNotNull() & ~F.isnan(value)
    rows = df.withColumn("_s", F.when(scored, value))
    steps = F.percentile_approx("_s", [i / GRID for i in range(GRID + 1)], ACCURACY)
    stats = rows.filter(F.col("_s").isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("_n"), steps.alias("_grid"))
    want = F.least(F.lit(n).cast("long"), F.col("_n")) if n is not None else F.ceil(F.round(F.lit(float(share)) * F.col("_n"), 6)).cast("long")
    # the grid's steps around the wanted quantile, one more to each side for the sketch's error
    at = F.floor((1 - F.col("_want") / F.col("_n")) * GRID)
    edge = lambda i: F.when((i >= 0) & (i <= GRID), F.element_at("_grid", F.least(F.greatest(i, F.lit(0)), F.lit(GRID)).cast("int") + 1))
    brackets = stats.withColumn("_want", want).select(
        F.col(group).alias("_group"), "_want", edge(at - 2).alias("_low"), edge(at + 3).alias("_high")).checkpoint(eager=True)
    met = rows.join(brackets, F.col(group).eqNullSafe(F.col("_group")), "left")
    above, below = F.col("_s") > F.col("_high"), F.col("_s") < F.col("_low")
    met = met.withColumn("_place", F.when(F.col("_s").isNull() | (F.col("_want") <= 0), "out").when(above, "in").when(below, "out").otherwise("edge"))
    sure = met.filter("_place = 'in'").groupBy(group).agg(F.count(F.lit(1)).alias("_sure")).select(F.col(group).alias("_sgroup"), "_sure")
    edge_rows = range_rank(met.filter("_place = 'edge'").select(*df.columns, "_s", "_want"), [group], [F.col("_s").desc(), F.col(id_col)], "_rank")
    edge_rows = edge_rows.join(sure, F.col(group).eqNullSafe(F.col("_sgroup")), "left")
    settled = edge_rows.select(*df.columns, (F.col("_rank") <= F.col("_want") - F.coalesce("_sure", F.lit(0))).alias("selected"))
    return met.filter("_place <> 'edge'").select(*df.columns, (F.col("_place") == "in").alias("selected")).unionByName(settled)


def exact_percentiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """(group, one column per name of ``shares``): the exact percentiles, interpolated between the two
    values at share * (n - 1).

    No group's values are gathered: the sketch's grid brackets each percentile, values below the
    bracket are counted, and only those inside are ranked, by ranges.  Null and NaN values do not count.
    """
    v = F.col(value).cast("double")
    rows = df.select(F.col(group).alias("_group"), v.alias("_v")).filter(v.isNotNull() & ~F.isnan(v))
    grid = F.percentile_approx("_v", [i / GRID for i in range(GRID + 1)], ACCURACY)
    stats = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"), grid.alias("_grid")).checkpoint(eager=True)
    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q")) for name, q in shares.items()]))
    wanted = stats.select("_group", "_n", "_grid", asked.alias("_a")).withColumn("_pos", F.col("_a.q") * (F.col("_n") - 1))
    # the steps below the lower and above the upper of the two values, two more for the sketch's error
    down, up = F.floor(F.floor("_pos") / F.col("_n") * GRID) - 2, F.ceil((F.ceil("_pos") + 1) / F.col("_n") * GRID) + 2
    edge = lambda i: F.when((i >= 0) & (i <= GRID), F.element_at("_grid", F.least(F.greatest(i, F.lit(0)), F.lit(GRID)).cast("int") + 1))
    wanted = wanted.select(F.col("_group").alias("_g"), F.col("_a.name").alias("_name"), "_pos", edge(down).alias("_low"), edge(up).alias("_high"))
    wanted = wanted.checkpoint(eager=True)  # a row for each group and percentile
    met = rows.join(wanted, F.col("_group").eqNullSafe(F.col("_g")))
    below = met.filter(F.col("_v") < F.col("_low")).groupBy("_g", "_name").agg(F.count(F.lit(1)).alias("_below")).select(
        F.col("_g").alias("_bg"), F.col("_name").alias("_bname"), "_below")
    inside = met.filter((F.col("_low").isNull() | (F.col("_v") >= F.col("_low"))) & (F.col("_high").isNull() | (F.col("_v") <= F.col("_high"))))
    # equal values cannot be told apart, so a value's rows are dealt by a number of their own
    inside = inside.select("_g", "_name", "_pos", "_v", F.monotonically_increasing_id().alias("_tie"))
    ranked = range_rank(inside, ["_g", "_name"], [F.col("_v"), F.col("_tie")], "_rank")
    ranked = ranked.join(below, F.col("_g").eqNullSafe(F.col("_bg")) & (F.col("_name") == F.col("_bname")), "left")
    place = F.col("_rank") - 1 + F.coalesce("_below", F.lit(0))
    lower, upper = F.floor("_pos"), F.ceil("_pos")
    ends = ranked.groupBy("_g", "_name").agg(F.max("_pos").alias("_pos"), F.max(F.when(place == lower, F.col("_v"))).alias("_lo"),
                                             F.max(F.when(place == upper, F.col("_v"))).alias("_hi"))
    between = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))
    picked = ends.select("_g", "_name", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(between).alias("_p"))
    return picked.groupBy(F.col("_g").alias(group)).agg(*[F.max(F.when(F.col("_name") == name, F.col("_p"))).alias(name) for name in shares])
