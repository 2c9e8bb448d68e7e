"""Row numbers that no single task has to compute.

``Window.orderBy`` without partitions, or partitioned by a key that holds a third of
the rows, sorts everything in one task.  Both helpers here cut the order into many
small pieces, count the pieces, and add the count of all pieces before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.session import stage_table

# hexadecimal digits of the hash that name a piece: 16**3 pieces per group
_PIECE_DIGITS = 3
_LOCAL_BITS = 33


def rank_by_range(df: DataFrame, keys: Sequence[Column | str], rank: str = "rank") -> DataFrame:
    """Add the 0-based position in the total order ``keys``.

    Range partitions on the whole key, so equal leading values are spread too.  Keys
    must be unique.  The sorted rows are written once: give narrow rows.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    staged = stage_table(
        ordered.withColumn("_row", F.monotonically_increasing_id()), "ranked"
    )
    piece = F.shiftright("_row", _LOCAL_BITS)
    within = F.col("_row").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    # one row per partition of the sort, a few thousand at most: safe to broadcast
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(piece.alias("_piece"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        staged.withColumn("_piece", piece)
        .join(F.broadcast(offsets), "_piece")
        .withColumn(rank, F.col("_before") + within)
        .drop("_row", "_piece", "_before")
    )


def rank_in_groups(
    df: DataFrame,
    group: str,
    order: Column,
    ties: Sequence[str],
    rank: str = "rank",
    first: Column | None = None,
) -> DataFrame:
    """Add the 1-based position inside ``group``, ordered by ``first`` (a number with a
    bounded set of values, optional), then ``order`` (a hexadecimal hash), then ``ties``.

    The leading digits of the hash cut every group into thousands of even pieces, so a
    hot group, or a hot value of ``first``, is sorted by many tasks.  Nothing is
    written and no action runs.
    """
    keyed = (
        df.withColumn("_first", F.lit(0) if first is None else first)
        .withColumn("_order", order)
        .withColumn("_piece", F.substring("_order", 1, _PIECE_DIGITS))
    )
    pieces = keyed.groupBy(group, "_first", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    by_first = pieces.groupBy(group, "_first").agg(F.sum("_n").alias("_total"))
    before_first = (
        Window.partitionBy(group).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    )
    before_piece = (
        Window.partitionBy(group, "_first")
        .orderBy("_piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = pieces.withColumn(
        "_before", F.coalesce(F.sum("_n").over(before_piece), F.lit(0))
    ).drop("_n")
    if first is not None:
        outer = by_first.select(
            group, "_first", F.coalesce(F.sum("_total").over(before_first), F.lit(0)).alias("_outer")
        )
        offsets = offsets.join(outer, [group, "_first"]).withColumn(
            "_before", F.col("_before") + F.col("_outer")
        ).drop("_outer")
    local = Window.partitionBy(group, "_first", "_piece").orderBy("_order", *ties)
    return (
        keyed.withColumn("_local", F.row_number().over(local))
        .join(offsets, [group, "_first", "_piece"])
        .withColumn(rank, (F.col("_before") + F.col("_local")).cast("bigint"))
        .drop("_first", "_order", "_piece", "_before", "_local")
    )
