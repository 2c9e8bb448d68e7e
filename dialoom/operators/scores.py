"""Embedding scores and thinning by score.

Rows need ``conv_id``, ``bin`` and ``embedding`` (question half, then answer half).
Statistics of a bin come from map-side combined aggregates; each row is then scored on
its own, so a bin may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions import vectors as V
from dialoom.functions.base import order_hash
from dialoom.operators.ranking import rank_by_range
from dialoom.session import stage_table

SCORES = ("cosine", "kl", "ner", "entropy", "variance_increase", "rand")
NO_FILTER = "none"


def mean_vector(df: DataFrame, vector: str = "embedding", by: str = "bin") -> DataFrame:
    """``(by, mean)``: the mean vector of each group, as ``array<double>``."""
    mean = Summarizer.mean(array_to_vector(V.as_double(F.col(vector))))
    return df.groupBy(by).agg(vector_to_array(mean).alias("mean"))


def minmax_by_half(df: DataFrame, by: str = "bin") -> DataFrame:
    """Smallest and largest entry of each half over all rows of a group."""
    e = V.as_double(F.col("embedding"))
    q, a = V.question_half(e), V.answer_half(e)
    return df.groupBy(by).agg(
        F.min(F.array_min(q)).alias("q_low"),
        F.max(F.array_max(q)).alias("q_high"),
        F.min(F.array_min(a)).alias("a_low"),
        F.max(F.array_max(a)).alias("a_high"),
    )


def join_bin_statistics(df: DataFrame, statistics: DataFrame) -> DataFrame:
    """Join one row per bin to the rows.

    The table is written first: every later use sees the same numbers, and the planner
    knows its size, so it broadcasts it if it is small and not otherwise.
    """
    return df.join(stage_table(statistics, "bin-statistics"), "bin")


def minmax_global(df: DataFrame) -> DataFrame:
    """Add ``q_scaled`` and ``a_scaled``: each half rescaled by its range in the bin."""
    joined = join_bin_statistics(df, minmax_by_half(df))
    e = V.as_double(F.col("embedding"))
    return (
        joined.withColumn(
            "q_scaled", V.rescale(V.question_half(e), F.col("q_low"), F.col("q_high"))
        )
        .withColumn(
            "a_scaled", V.rescale(V.answer_half(e), F.col("a_low"), F.col("a_high"))
        )
        .drop("q_low", "q_high", "a_low", "a_high")
    )


def mean_cosine_score(df: DataFrame, population: DataFrame | None = None) -> DataFrame:
    """Add ``mean_cosine``: mean similarity to all rows of the bin, itself included.

    The mean of the products is the product with the mean, so the work grows with the
    rows and not with their square.  ``population`` gives the rows of the bins if they
    are more than ``df``.
    """
    unit = V.l2_normalize(F.col("embedding"))
    rows = df if population is None else population
    means = mean_vector(rows.select("bin", unit.alias("embedding")))
    return (
        join_bin_statistics(df, means)
        .withColumn("mean_cosine", V.dot(unit, F.col("mean")))
        .drop("mean")
    )


def with_score(
    df: DataFrame, kind: str, seed: int = 0, population: DataFrame | None = None
) -> DataFrame:
    """Add ``score``; the highest scores are kept."""
    e = V.as_double(F.col("embedding"))
    if kind == "cosine":
        scored = mean_cosine_score(df, population)
        return scored.withColumn("score", 1 - F.col("mean_cosine")).drop("mean_cosine")
    if kind == "kl":
        return (
            minmax_global(df)
            .withColumn("score", V.kl_divergence(F.col("q_scaled"), F.col("a_scaled")))
            .drop("q_scaled", "a_scaled")
        )
    if kind == "ner":
        return df.withColumn("score", V.normalized_effective_rank(F.col("embedding")))
    if kind == "entropy":
        return df.withColumn("score", V.entropy(e))
    if kind == "variance_increase":
        joined = join_bin_statistics(df, mean_vector(df))
        return joined.withColumn(
            "score", V.euclidean_distance(e, F.col("mean"))
        ).drop("mean")
    if kind == "rand":
        head = F.substring(order_hash(seed, F.col("conv_id")), 1, 13)
        return df.withColumn("score", F.conv(head, 16, 10).cast("double"))
    raise ValueError(f"no such score: {kind}")


def select_top(scored: DataFrame, quota: DataFrame) -> DataFrame:
    """Keep, in each bin, the ``keep`` rows with the highest ``score``, ties by id.

    NaN ranks first, then +inf; rows without a score come last.  ``quota`` is a written table ``(bin, cnt, keep)``; a
    null ``keep`` keeps the whole bin.  Only bin, score and id are sorted.  The last row
    inside the quota gives one limit per bin, and the full rows are compared with it
    where they are: they are not shuffled.
    """
    limited = quota.where(F.col("keep").isNotNull())
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bin: the rank of the last row to keep, in the order of all bins
    last_rows = limited.select(
        "bin",
        "keep",
        (
            F.coalesce(F.sum("cnt").over(before), F.lit(0)) + F.least("keep", "cnt") - 1
        ).alias("rank"),
    ).where(F.col("keep") > 0)
    ranked = rank_by_range(
        scored.join(limited.select("bin"), "bin", "left_semi").select(
            "bin", "score", "conv_id"
        ),
        ["bin", F.col("score").isNull(), F.desc("score"), "conv_id"],
    )
    limits = stage_table(
        ranked.join(last_rows, ["bin", "rank"]).select(
            "bin", F.col("score").alias("_score"), F.col("conv_id").alias("_last")
        ),
        "limits",
    )
    rules = quota.select("bin", "keep").join(limits, "bin", "left")
    unscored = F.col("_score").isNull()
    before_last = F.col("conv_id") <= F.col("_last")
    inside = F.col("_last").isNotNull() & F.when(
        F.col("score").isNull(), unscored & before_last
    ).otherwise(
        unscored
        | (F.col("score") > F.col("_score"))
        | ((F.col("score") == F.col("_score")) & before_last)
    )
    return (
        scored.join(rules, "bin")
        .where(F.col("keep").isNull() | F.coalesce(inside, F.lit(False)))
        .drop("keep", "_score", "_last")
    )


def keep_counts(
    df: DataFrame, ratios: DataFrame, first: str, second: str
) -> DataFrame:
    """``(bin, cnt, keep1, keep2)`` from ``(bin, keep_ratio)``; null means keep all.

    Both stages use the square root of the ratio, also when only one of them is on.
    """
    root = F.sqrt("keep_ratio")
    active = [f != NO_FILTER for f in (first, second)]
    known = [f in SCORES for f in (first, second)]
    n = F.col("cnt")
    keep1 = F.floor(n * root) if known[0] else n
    keep2 = F.floor(keep1 * root) if known[1] else keep1
    thin = (F.col("keep_ratio") < 1) & F.lit(any(active))
    counts = df.groupBy("bin").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.join(ratios, "bin").select(
        "bin",
        "cnt",
        F.when(thin, keep1).alias("keep1"),
        F.when(thin, keep2).alias("keep2"),
    )


def two_stage_filter(
    df: DataFrame, ratios: DataFrame, first: str = "kl", second: str = "ner", seed: int = 0
) -> DataFrame:
    """Thin each bin to its ratio with two scores, one after the other.

    The second score's statistics are those of the survivors, except for ``cosine``
    and ``ner``, which look at the whole bin.  After a first stage by ``cosine`` the
    second stage sees unit vectors.  An unknown filter name keeps everything.
    """
    quotas = stage_table(keep_counts(df, ratios, first, second), "quotas")
    if first not in SCORES and second not in SCORES:
        return df.join(quotas.select("bin"), "bin", "left_semi").select(*df.columns)
    # bin, id and vector decide; each score is computed once, and the full rows follow in
    # one join on the ids that are left
    whole = df.select("bin", "conv_id", "embedding")
    left = whole
    if first in SCORES:
        scored = stage_table(with_score(left, first, seed), "first-scores")
        left = select_top(
            scored, quotas.select("bin", "cnt", F.col("keep1").alias("keep"))
        ).drop("score")
    if second in SCORES:
        rows = left
        if first == "cosine" and second != "cosine":
            rows = left.withColumn("embedding", V.l2_normalize(F.col("embedding")))
        scored = stage_table(
            with_score(rows, second, seed + 1, population=whole).select("bin", "conv_id", "score"),
            "second-scores",
        )
        left = select_top(
            scored,
            quotas.select("bin", F.col("keep1").alias("cnt"), F.col("keep2").alias("keep")),
        )
    return df.join(stage_table(left.select("conv_id"), "survivors"), "conv_id", "left_semi").select(
        *df.columns
    )


def select_top_ratio(df: DataFrame, ratio: float) -> DataFrame:
    """Keep ``floor(n * ratio)`` rows of each bin by ``score``."""
    n = F.count(F.lit(1))
    quota = df.groupBy("bin").agg(
        n.alias("cnt"), F.floor(n * F.lit(float(ratio))).alias("keep")
    )
    return select_top(df, stage_table(quota, "quotas"))
