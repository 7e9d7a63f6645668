"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, gapless_rank, row_key, same, shuffled, uniform, written

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target stops at this many times its size.
MAX_REPEAT = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target, rate) from (source, source_size), one row per source.

    Targets share the total size by weight; a target above ``max_repeat`` times its
    source's size is cut to that, and what is cut is shared among the others by weight,
    until none is above.  Closed form: with sources in order of cap / weight, the first
    ones are capped, and the others get ``weight * (total - capped) / (their weights)``;
    the prefix sums over the table of sources (one row per source) find the split.  A source without words has target 0 and rate 1 (each
    document once).  The windows run over one row per source, not over documents.
    """
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * max_repeat)
    by_ratio = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    s = s.withColumn("left_size", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    s = s.withColumn("left_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    s = s.withColumn("pos", F.row_number().over(by_ratio))
    level = F.col("left_size").cast("double") / F.col("left_w").cast("double")
    free = F.col("cap").cast("double") > F.col("w") * level
    first_level = F.min(F.when(free, F.struct("pos", "left_size", "left_w"))).over(whole)
    s = s.withColumn("f", first_level)
    shared = F.col("w") * (F.col("f.left_size").cast("double") / F.col("f.left_w").cast("double"))
    capped = F.col("f").isNull() | (F.col("cap").cast("double") <= shared)
    s = s.withColumn("target", F.when(capped, F.col("cap").cast("double")).otherwise(shared))
    rate = F.when(F.col("source_size") == 0, F.lit(1.0)).otherwise(F.col("target") / F.col("source_size"))
    return s.select("source", "source_size", "target", rate.alias("rate"))


def sample_copies(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
                  seed: int = 7, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """doc_id, source, key, size, source_size, target, copies of every row of ``docs``.

    Within a source every document is expected ``target / source_size`` times; the
    documents stand in order of size, id and row key, the expected copies are prefix-summed, one
    random offset in [0, 1) from (seed, source) is added, and a document is emitted once
    per integer that its step crosses.  The order by size keeps the words taken within
    about one largest document of the target.  Ranks come from ranges of (source, size,
    id), so a source with a third of all rows is spread.  A null or blank text has size 0;
    null sources form one source, last.  Reruns agree: the offset is a hash.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
                       word_count(F.col(f"`{text}`")).alias("size"), row_key(docs).alias("key"))
    ranked = gapless_rank(rows, ["source"], [F.col("size"), F.col("doc_id"), F.col("key")], "rank")
    ranked = written(ranked, "mix-ranks")
    targets = source_targets(ranked.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeat)
    targets = written(targets, "mix-targets").select(
        F.col("source").alias("t_source"), "source_size", "target", "rate")
    j = ranked.join(targets, same([F.col("source")], [F.col("t_source")]))
    offset = uniform("systematic", str(seed), F.col("source"))
    step = lambda k: F.floor(k * F.col("rate") + offset)
    copies = step(F.col("rank") + 1) - step(F.col("rank"))
    return j.select("doc_id", "source", "key", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as many times as ``sample_copies`` says,
    all columns kept.  Fully equal rows are one class: their copies are added up."""
    copies = sample_copies(docs, **options).groupBy("doc_id", "key").agg(
        F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    copies = written(copies.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "__copies", "__rows")
                     .filter("__copies > 0"), "mix-copies")
    id_col = F.col(f"`{options.get('doc_id', 'doc_id')}`")
    keyed = docs.withColumn("__row", row_key(docs))
    j = keyed.join(shuffled(copies), id_col.eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__key")))
    names = [F.col(f"`{c}`") for c in docs.columns]
    single = j.filter("__rows = 1").select(*names, "__copies")
    repeated = j.filter("__rows > 1").dropDuplicates(["__id", "__key"]).select(*names, "__copies")
    out = single.unionByName(repeated).withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return out.select(*names)
