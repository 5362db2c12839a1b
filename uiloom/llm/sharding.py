"""Sharding by rendezvous hashing.

Every shard bids for every key; the highest bid wins. A bid depends on the key and the shard
alone, so one more shard takes keys only into itself and no other key moves. The bid
-weight / ln(u), with u uniform in (0, 1), gives each shard a share in proportion to its weight.

Edge cases: a null key is a key of its own, so all rows without a key share a shard, whatever their number (under this law rows of one key always do; slots are
numbered in parts all the same); texts play no part; equal rows share a shard and get different slots;
an empty table gives an empty result; further columns pass through, and a column that has the
name of an output is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uiloom.llm.common import stage

#: Parts of a shard that are numbered on their own, and the spread of equal rows over them.
SLOT_PARTS, SLOT_SALTS = 256, 64


def bid(key: Column, shard: int, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(float(2**53))
    return F.struct((F.lit(-float(weight)) / F.ln(u)).alias("bid"), F.lit(-shard).alias("shard"))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard, from 0, that wins the key."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights: one positive number for each shard")
    bids = [bid(key, shard, weight) for shard, weight in enumerate(weights)]
    return -(F.greatest(*bids) if len(bids) > 1 else bids[0])["shard"]


def shard_records(df: DataFrame, key: str, weights: Sequence[float], *, grown_weight: float | None = None) -> DataFrame:
    """Add `shard`, and `grown_shard` (with one more shard of grown_weight) where that is given."""
    weights = list(weights)
    out = df.withColumn("shard", rendezvous(F.col(key), weights))
    if grown_weight is not None:
        out = out.withColumn("grown_shard", rendezvous(F.col(key), [*weights, grown_weight]))
    return out


def number_slots(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add `slot`, gapless from 0 in each shard.

    A shard is numbered in parts that no key fills alone: a part is chosen by the row's columns in
    `order` and its place in the input, rows are numbered in their part, and the running total of
    the parts before it (SLOT_PARTS rows a shard) is added. The table is staged between, so both
    steps see the same parts. df should hold few, narrow columns.
    """
    place = F.pmod(F.monotonically_increasing_id(), F.lit(SLOT_SALTS))
    part = F.pmod(F.xxhash64(*order, place), F.lit(SLOT_PARTS)).cast("int")
    staged = stage(df.withColumn("_part", part), "slots")
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        staged.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
        .select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("shard", "_part").orderBy(*order)
    numbered = staged.withColumn("_row", F.row_number().over(within) - 1)
    # starts has at most SLOT_PARTS rows a shard, whatever the input
    return (
        numbered.join(F.broadcast(starts), ["shard", "_part"])
        .withColumn("slot", (F.col("_start") + F.col("_row")).cast("long"))
        .drop("_part", "_start", "_row")
    )


def write_shards(df: DataFrame, path: str) -> None:
    """One folder of Parquet files for each shard; no task has to hold a shard."""
    df.write.partitionBy("shard").parquet(path)
