"""Weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank


def rendezvous_score(keys: list[Column], shard: int, weight: float) -> Column:
    """``-weight / ln(u)`` with ``u`` in (0, 1) from the XXH64 of (keys, shard): the
    shard with the largest score wins with probability weight / sum of weights."""
    u = (F.shiftrightunsigned(F.xxhash64(*keys, F.lit(shard)), 12).cast("double") + 0.5) / F.lit(2.0**52)
    return F.lit(-float(weight)) / F.log(u)


def rendezvous_shard(keys: list[Column], weights: list[float]) -> Column:
    """The shard (position in ``weights``) with the highest score for the key.

    Each score depends on the key and its own shard alone: adding a shard moves only
    the records that the new shard wins, and dropping one moves only its own records.
    A weight of zero or less takes no record.  Ties go to the smaller shard.
    """
    scored = [F.struct(rendezvous_score(keys, s, w).alias("score"), F.lit(-s).alias("neg"))
              for s, w in enumerate(weights) if w > 0]
    if not scored:
        raise ValueError("at least one shard needs a positive weight")
    best = scored[0] if len(scored) == 1 else F.greatest(*scored)
    return (-best["neg"]).cast("int")


def shard_records(df: DataFrame, key: list[str], weights: list[float], grown_weights: list[float] | None = None,
                  text: str = "text") -> DataFrame:
    """key columns, size, text_crc32, shard, slot, grown_shard of every row.

    ``size`` is the UTF-8 length of the text (null: 0) plus 16, ``text_crc32`` the
    unsigned CRC-32 of the text (null: as the empty text, 0).  ``slot`` counts 0, 1, ...
    within a shard in the order of key, checksum and size; its ranks come from ranges of
    (shard, key), so a heavy shard is not one task.  ``grown_shard`` is the shard under
    ``grown_weights`` (null if none are given).  A null key hashes like an absent one:
    all rows without a key share a shard.  Repeated rows share a shard and get slots of
    their own.  Other columns are left out, so their names cannot clash.
    """
    keys = [F.col(f"`{k}`") for k in key]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    grown = rendezvous_shard(keys, grown_weights) if grown_weights else F.lit(None).cast("int")
    placed = df.select(
        *keys, (F.octet_length(body).cast("long") + 16).alias("size"), F.crc32(body).alias("text_crc32"),
        rendezvous_shard(keys, weights).alias("shard"), grown.alias("grown_shard"))
    order = [*keys, F.col("text_crc32"), F.col("size")]
    return gapless_rank(placed, ["shard"], order, "slot")
