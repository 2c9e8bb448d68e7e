"""Equal-width bins over record sizes, and the tables made from them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.operators.scores import two_stage_filter
from dialoom.session import stage_table


@dataclass(frozen=True)
class Binning:
    """``nbins`` equal bins from ``low`` to ``high``; the largest size has a bin of its
    own, number ``nbins``."""

    nbins: int
    low: int
    high: int
    single: bool = False  # no candidate separated the sizes: one bin for all

    def column(self, nbytes: Column) -> Column:
        if self.single:
            return F.lit(0).cast("bigint")
        if self.high == self.low:
            return F.lit(self.nbins).cast("bigint")
        return bin_number(nbytes, F.lit(self.nbins), self.low, self.high)


def bin_number(nbytes: Column, nbins: Column, low: int, high: int) -> Column:
    """Interval of a size, in whole numbers only.  Needs ``high > low``."""
    scaled = (nbytes - F.lit(low)).cast("bigint") * nbins.cast("bigint")
    return F.call_function("div", scaled, F.lit(high - low).cast("bigint"))


def size_range(df: DataFrame) -> tuple[int, int, int] | None:
    """Smallest size, largest size and number of records; None for no records."""
    row = df.agg(
        F.min("nbytes").alias("low"),
        F.max("nbytes").alias("high"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    return (row.low, row.high, row.n) if row.n else None


def assign_bins(df: DataFrame, binning: Binning, name: str = "bin") -> DataFrame:
    return df.withColumn(name, binning.column(F.col("nbytes")))


def bin_counts(binned: DataFrame, nbins: int) -> DataFrame:
    """``(bin, cnt)`` for every bin, empty and overflow bins included."""
    counted = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("cnt"))
    every = binned.sparkSession.range(0, nbins + 1).select(F.col("id").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt")
    )


def bin_ranking(counts: DataFrame) -> DataFrame:
    """Add ``bin_rank``, 0 for the fullest bin.  One row per bin: a small table."""
    order = Window.orderBy(F.desc("cnt"), F.desc("bin"))
    return counts.withColumn("bin_rank", (F.row_number().over(order) - 1).cast("bigint"))


def size_counts(df: DataFrame) -> DataFrame:
    """``(nbytes, cnt)``: at most one row per possible size."""
    return df.groupBy("nbytes").agg(F.count(F.lit(1)).alias("cnt"))


def _square_sum(counts: np.ndarray) -> int:
    """Sum of squares in whole numbers of any size."""
    high, low = counts >> 20, counts & ((1 << 20) - 1)
    parts = [int((x * y).sum()) for x, y in ((high, high), (high, low), (low, low))]
    return (parts[0] << 40) + (parts[1] << 21) + parts[2]


def _judge(sizes: np.ndarray, cumulative: np.ndarray, low: int, high: int):
    """Judges candidates on the cumulative histogram: the count of a bin is a difference of
    two of its entries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = int(cumulative[-1])
        for batch in batches:
            rows = []
            for n in batch["nbins"]:
                n = int(n)
                if high == low:
                    counts = np.array([total])
                else:
                    # the first size of bin b is the least x with (x - low) * n >= b * width
                    firsts = low + -(-np.arange(n + 1, dtype=np.int64) * (high - low) // n)
                    at = np.append(np.searchsorted(sizes, firsts), len(sizes))
                    counts = np.diff(cumulative[at])
                filled = int((counts > 0).sum())
                squares = _square_sum(counts)
                # exact until the division, so near ties do not depend on an order
                variance = (squares * (n + 1) - total * total) / ((n + 1) * (n + 1))
                average = total / filled
                score = max(average / n, float(low)) / variance**0.5 if variance > 1e-9 else None
                rows.append((n, average, max(variance, 0.0) ** 0.5, score, n > average))
            columns = ["nbins", "average", "deviation", "score", "stop"]
            yield pd.DataFrame(rows, columns=columns)

    return run


def bin_candidates(
    sizes: DataFrame, low: int, high: int, first: int, last: int
) -> DataFrame:
    """Judge the bin numbers ``first`` … ``last`` on the size histogram ``(nbytes, cnt)``.

    ``score`` is the smallest allowed count over the deviation of the counts, lower is
    better; ``stop`` is set once there are more bins than records per bin.  The histogram
    has one row per possible size, which the size cap bounds, and travels with the tasks;
    the candidates are spread over them and nothing is shuffled.
    """
    rows = sizes.orderBy("nbytes").toPandas()
    counts = rows["cnt"].to_numpy(np.int64)
    cumulative = np.concatenate(([0], np.cumsum(counts)))
    judge = _judge(rows["nbytes"].to_numpy(np.int64), cumulative, low, high)
    candidates = sizes.sparkSession.range(first, last + 1).withColumnRenamed("id", "nbins")
    return candidates.mapInPandas(
        judge, "nbins bigint, average double, deviation double, score double, stop boolean"
    )


def optimal_bins(df: DataFrame, force: int | None = None, chunk: int = 256) -> Binning | None:
    """The bin number with the lowest score, the first one on ties.

    Sizes are counted once; every candidate is judged on that histogram.  Candidates
    are taken chunk by chunk until the stop rule fires, and each chunk comes back as
    one row.  None for no records.
    """
    if force is not None:
        limits = size_range(df)
        return Binning(force, limits[0], limits[1]) if limits else None
    sizes = stage_table(size_counts(df), "sizes")
    limits = sizes.agg(F.min("nbytes").alias("low"), F.max("nbytes").alias("high")).first()
    if limits.low is None:
        return None
    low, high = limits.low, limits.high
    best: tuple[float, int] | None = None
    first = 2
    while first <= high:
        last = min(first + chunk - 1, high)
        judged = bin_candidates(sizes, low, high, first, last)
        until = F.min(F.when(F.col("stop"), F.col("nbins")))
        row = judged.agg(
            until.alias("stop"),
            # the least score up to each candidate that may be the stop
            F.sort_array(
                F.collect_list(F.when(F.col("score").isNotNull(), F.struct("score", "nbins")))
            ).alias("scores"),
        ).first()
        reached = [s for s in row.scores if row.stop is None or s.nbins <= row.stop]
        if reached and (best is None or reached[0].score < best[0]):
            best = (reached[0].score, reached[0].nbins)
        if row.stop is not None:
            break
        first, chunk = last + 1, min(chunk * 2, 4096)
    return Binning(1, low, high, single=True) if best is None else Binning(best[1], low, high)


def bin_targets(counts: DataFrame, nbins: int, min_nbytes: int, boost: float = 1.0) -> DataFrame:
    """Add ``bin_rank``, ``target`` and ``keep_ratio`` to the bin table."""
    every = Window.partitionBy(F.lit(0))
    average = F.sum("cnt").over(every) / F.count_if(F.col("cnt") > 0).over(every)
    least = F.greatest(
        average / F.lit(nbins) * F.lit(1.0 - boost), F.lit(float(min_nbytes))
    )
    return (
        bin_ranking(counts)
        .withColumn("target", least * F.greatest(F.lit(1), F.lit(nbins) - F.col("bin_rank")))
        .withColumn("keep_ratio", F.when(F.col("cnt") > 0, F.col("target") / F.col("cnt")))
    )


def histogram_filter(
    binned: DataFrame,
    nbins: int,
    boost: float = 1.0,
    first: str = "kl",
    second: str = "ner",
    seed: int = 0,
) -> DataFrame:
    """Thin over-full bins by score; bins of one or two records are kept whole."""
    limits = size_range(binned)
    if limits is None:
        return binned
    targets = bin_targets(bin_counts(binned, nbins), nbins, limits[0], boost)
    return filter_by_targets(binned, targets, first, second, seed)


def filter_by_targets(
    binned: DataFrame, targets: DataFrame, first: str, second: str, seed: int = 0
) -> DataFrame:
    """Thin each bin to its ``keep_ratio`` in the bin table."""
    ratios = targets.where(F.col("cnt") > 0).select(
        "bin", F.when(F.col("cnt") > 2, F.col("keep_ratio")).otherwise(1.0).alias("keep_ratio")
    )
    return two_stage_filter(binned, ratios, first, second, seed)


def size_histogram(df: DataFrame, nbins: int) -> DataFrame:
    """Counts per size interval with a bar of stars; the last one includes the largest
    size.  A report of at most ``nbins`` rows; printing is the caller's."""
    limits = size_range(df)
    low, high, _ = limits or (0, 0, 0)
    n = min(nbins, high - low)
    if n <= 0:
        return df.sparkSession.createDataFrame(
            [], "bin bigint, size_range string, cnt bigint, bar string"
        )
    bin_ = F.least(bin_number(F.col("nbytes"), F.lit(n), low, high), F.lit(n - 1))
    counted = df.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    every = df.sparkSession.range(0, n).select(F.col("id").alias("bin"))
    width = F.lit(float(high - low)) / F.lit(n)

    def edge(i):
        return F.bround(F.lit(float(low)) + i * width, 0).cast("bigint").cast("string")

    cnt = F.coalesce("cnt", F.lit(0)).cast("bigint")
    largest = F.max(cnt).over(Window.partitionBy(F.lit(0)))
    return every.join(counted, "bin", "left").select(
        "bin",
        F.concat(edge(F.col("bin")), F.lit("-"), edge(F.col("bin") + 1)).alias("size_range"),
        cnt.alias("cnt"),
        F.repeat(
            F.lit("*"), F.floor(cnt * (F.lit(100.0) / largest)).cast("int")
        ).alias("bar"),
    )
