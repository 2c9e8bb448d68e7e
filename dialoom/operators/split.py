"""Stratified train and test sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.functions.base import order_hash
from dialoom.operators.bins import bin_number
from dialoom.operators.ranking import rank_in_groups
from dialoom.session import stage_table


def _split_strata(df: DataFrame, stratum: str, test_ratio: float, seed: int) -> DataFrame:
    """First ``floor(n * ratio)`` rows of each stratum, in seeded hash order, are test."""
    ranked = rank_in_groups(
        df, stratum, order_hash(f"{seed}s", F.col("conv_id")), ["conv_id"], rank="_rank"
    )
    sizes = stage_table(
        df.groupBy(stratum).agg(
            F.floor(F.count(F.lit(1)) * F.lit(float(test_ratio))).alias("_test")
        ),
        "strata",
    )
    return (
        ranked.join(sizes, stratum)
        .withColumn(
            "split", F.when(F.col("_rank") <= F.col("_test"), "test").otherwise("train")
        )
        .drop("_rank", "_test")
    )


def split_by_segment(
    curriculum: DataFrame, nbins: int, test_ratio: float = 0.1, seed: int = 0
) -> DataFrame:
    """Split ``nbins`` positional segments; the last one takes the remainder.

    Needs ``position``; adds ``segment`` and ``split``.  Give narrow rows: they are
    written first.
    """
    curriculum = stage_table(curriculum, "positions")
    n = curriculum.count()
    size = n // max(1, nbins)
    last = F.lit(max(1, nbins) - 1).cast("bigint")
    segment = (
        F.least(F.floor(F.col("position") / size).cast("bigint"), last) if size else last
    )
    return _split_strata(
        curriculum.withColumn("segment", segment), "segment", test_ratio, seed
    )


def split_by_size_bin(
    df: DataFrame,
    nbins: int,
    test_ratio: float = 0.1,
    seed: int = 0,
    include_max: bool = True,
) -> DataFrame:
    """Split inside ``nbins`` half-open size bins from 0 to the largest size.

    The largest size lies in no bin: it joins the last one, or with
    ``include_max=False`` is in neither set.  Adds ``size_bin`` and ``split``.  Give
    narrow rows: they are written first.
    """
    df = stage_table(df, "sizes")
    high = df.agg(F.max("nbytes").alias("high")).first().high
    if not high:
        return df.withColumn("size_bin", F.lit(0).cast("bigint")).withColumn(
            "split", F.lit("train")
        )
    number = bin_number(F.col("nbytes"), F.lit(nbins), 0, high)
    if include_max:
        number = F.least(number, F.lit(nbins - 1).cast("bigint"))
    binned = df.withColumn("size_bin", number).where(F.col("size_bin") < nbins)
    return _split_strata(binned, "size_bin", test_ratio, seed)


def split_counts(total: DataFrame, split: DataFrame) -> DataFrame:
    """``(split, cnt)`` of total, train and test."""
    whole = total.agg(F.count(F.lit(1)).alias("cnt")).select(
        F.lit("total").alias("split"), "cnt"
    )
    return whole.unionByName(split.groupBy("split").agg(F.count(F.lit(1)).alias("cnt")))


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """``(stage, cnt)``: records after each named stage."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("stage"), "cnt")
        for name, df in stages.items()
    ]
    report = counted[0]
    for more in counted[1:]:
        report = report.unionByName(more)
    return report
