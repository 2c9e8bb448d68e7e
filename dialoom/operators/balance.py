"""Balancing the size distribution into a curriculum."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions.base import order_hash
from dialoom.operators.bins import bin_number, size_range
from dialoom.operators.ranking import rank_in_groups
from dialoom.session import stage_table


def fill_plan(counts: DataFrame, target: int) -> DataFrame:
    """What happens to each bin, from small to large sizes.

    ``kept`` own records stay; ``excess`` ones go to a pool; ``taken`` ones come from
    the pool of the smaller bins.  ``excess_start`` and ``taken_start`` number the
    records put into and taken from the pool, ``start`` is the bin's first position.
    The pool after bin k is S(k) - min(0, S(1..k)), S being the running sum of
    count - target.  One row per bin: a small table.
    """
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    t = F.lit(target)
    running = counts.withColumn("_s", F.sum(F.col("cnt") - t).over(upto))
    pooled = running.withColumn(
        "_pool", F.col("_s") - F.least(F.lit(0), F.min("_s").over(upto))
    )
    pool_before = F.coalesce(F.lag("_pool").over(Window.orderBy("bin")), F.lit(0))
    taken = F.least(F.greatest(t - F.col("cnt"), F.lit(0)), pool_before)
    plan = pooled.withColumn("taken", taken).select(
        "bin",
        "cnt",
        F.least("cnt", t).alias("kept"),
        F.greatest(F.col("cnt") - t, F.lit(0)).alias("excess"),
        "taken",
    )

    def total_before(column):
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    return plan.select(
        "*",
        total_before(F.col("excess")).alias("excess_start"),
        total_before(F.col("taken")).alias("taken_start"),
        total_before(F.col("kept") + F.col("taken")).alias("start"),
    )


def _pool_slots(plan: DataFrame, block: int) -> DataFrame:
    """Ranges of pool numbers that fill each bin, cut into blocks for an equi-join.

    A block spans about as many numbers as a bin takes on average, so a block meets
    few ranges however uneven the bins are.
    """
    last = F.col("taken_start") + F.col("taken") - 1
    return plan.where(F.col("taken") > 0).select(
        F.explode(
            F.sequence(
                F.floor(F.col("taken_start") / block).cast("bigint"),
                F.floor(last / block).cast("bigint"),
            )
        ).alias("block"),
        F.col("taken_start").alias("from_number"),
        last.alias("to_number"),
        F.col("bin").alias("target_bin"),
        (F.col("start") + F.col("kept")).alias("fill_start"),
    )


def balance_bins(
    df: DataFrame, nbins: int, seed: int = 0, include_max: bool = True
) -> tuple[DataFrame, int]:
    """Fill every bin up to ``ceil(records / nbins)`` records.

    Returns the kept records with ``bin`` (by own size), ``target_bin`` and 0-based
    ``position`` in the balanced list, and the bin target.  Over-full bins give their
    excess, in seeded hash order, to larger bins in need; what nobody needs is left
    out.  The largest size is clamped into the last bin, or left out as an overflow bin
    with ``include_max=False``.  Give ``conv_id`` and ``nbytes`` only: they are written
    first, and so is the result.  The wide columns come back with a join on ``conv_id``.
    """
    df = stage_table(df, "sizes")
    limits = size_range(df)
    if nbins == 0 or limits is None or limits[0] == limits[1]:
        alone = rank_in_groups(
            df.withColumn("bin", F.lit(0).cast("bigint")),
            "bin",
            order_hash(seed, F.col("conv_id")),
            ["conv_id"],
        )
        return (
            alone.select(
                *df.columns,
                "bin",
                F.col("bin").alias("target_bin"),
                (F.col("rank") - 1).alias("position"),
            ),
            limits[2] if limits else 0,
        )
    low, high, n = limits
    target = math.ceil(n / nbins)
    bins = min(nbins, high - low)
    number = bin_number(F.col("nbytes"), F.lit(bins), low, high)
    if include_max:
        number = F.least(number, F.lit(bins - 1).cast("bigint"))
    binned = df.withColumn("bin", number).where(F.col("bin") < bins)

    counted = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("cnt"))
    every = df.sparkSession.range(0, bins).select(F.col("id").alias("bin"))
    counts = every.join(counted, "bin", "left").select(
        "bin", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt")
    )
    plan = stage_table(fill_plan(counts, target), "fill-plan")
    taken = plan.agg(F.sum("taken").alias("n")).first().n or 0
    block = max(1, math.ceil(taken / bins))
    slots = _pool_slots(plan, block)

    # over-full bins are drawn from at random, the others keep their size order
    full = F.col("cnt") > target
    ranked = rank_in_groups(
        binned.join(plan, "bin"),
        "bin",
        order_hash(seed, F.col("conv_id")),
        ["conv_id"],
        first=F.when(full, F.lit(0)).otherwise(F.col("nbytes")),
    )
    number = F.col("excess_start") + F.col("rank") - 1 - F.col("kept")
    numbered = ranked.withColumn(
        "number", F.when(F.col("rank") > F.col("kept"), number)
    ).withColumn("block", F.floor(F.col("number") / block).cast("bigint"))
    own = numbered.where(F.col("number").isNull()).select(
        *df.columns,
        "bin",
        F.col("bin").alias("target_bin"),
        (F.col("start") + F.col("rank") - 1).alias("position"),
    )
    moved = (
        numbered.where(F.col("number").isNotNull())
        .join(slots, "block")
        .where(F.col("number").between(F.col("from_number"), F.col("to_number")))
        .select(
            *df.columns,
            "bin",
            "target_bin",
            (F.col("fill_start") + F.col("number") - F.col("from_number")).alias("position"),
        )
    )
    return stage_table(own.unionByName(moved), "balanced"), target


def curriculum_shuffle(balanced: DataFrame, target: int, seed: int = 0) -> DataFrame:
    """Shuffle inside chunks of ``target`` positions; the order of chunks stays.

    Adds ``chunk`` and replaces ``position``.
    """
    size = max(1, target)
    chunked = balanced.withColumn("chunk", F.floor(F.col("position") / size).cast("bigint"))
    ranked = rank_in_groups(
        chunked, "chunk", order_hash(f"{seed}c", F.col("conv_id")), ["conv_id"]
    )
    return ranked.withColumn(
        "position", F.col("chunk") * size + F.col("rank") - 1
    ).drop("rank")


def chunk_stats(curriculum: DataFrame) -> DataFrame:
    return curriculum.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min("nbytes").alias("min_nbytes"),
        F.max("nbytes").alias("max_nbytes"),
    )
