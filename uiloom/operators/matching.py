"""Joins that assert how many partners a row has, and sorted output with gapless positions."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exactly_one(required: DataFrame, offers: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Required rows with `offer` (a struct of the one offer of equal keys), and violations: required rows with code `missing` or `repeated`.

    Offers are counted before they are joined, so a key with very many of them costs one row; they must not hold maps. A required row that occurs twice is answered twice. A null key is offered
    nothing. Offers that nobody requires play no part."""
    kept = [c for c in offers.columns if c not in keys]
    counted = offers.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(F.struct(*kept) if kept else F.struct(F.lit(1).alias("exists"))).alias("offer"))
    joined = required.join(counted, keys, "left")
    code = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "repeated")
    judged = joined.withColumn("code", code).drop("_n")
    return judged.where("code IS NULL").drop("code"), judged.where("code IS NOT NULL").drop("offer")


def complete(required: DataFrame, offers: DataFrame, keys: list[str], group: list[str]) -> tuple[DataFrame, DataFrame]:
    """exactly_one, but all or nothing for each group: a group with a violation gives no match."""
    matches, violations = exactly_one(required, offers, keys)
    broken = violations.select(*group).distinct()
    return matches.join(broken, group, "left_anti"), violations


def positions(df: DataFrame, order: list[Column | str], within: list[str] | None = None, name: str = "position") -> DataFrame:
    """df sorted by `order`, with gapless positions from 0 (in each group of `within`, which must be the first columns of `order`).

    Rows are dealt over ranges and sorted there; the rows before a range are added to the places in it, so no task sees more than its range. The sorted rows are kept by checkpoint()
    in the folder of spark.checkpoint.dir (a temporary one in local mode if that isn't set) and read for both steps;
    Spark deletes them with their rows if spark.cleaner.referenceTracking.cleanCheckpoints is set. Rows that are equal in `order` come in any order."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    keys = within or []
    ranges = dealt.groupBy(*keys, part.alias("_part")).agg(F.count("*").alias("_n"), F.min(place).alias("_first"))
    # a row for each range (and each group in it)
    before = Window.partitionBy(*keys or [F.lit(0)]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(*keys, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = dealt.withColumn("_part", part).join(starts, [*keys, "_part"])
    return joined.withColumn(name, place - F.col("_first") + F.col("_start")).drop("_at", "_part", "_first", "_start")
