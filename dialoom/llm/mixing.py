"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.llm.common import WORD, narrow
from dialoom.session import stage_table

DEFAULT_WEIGHTS = (5, 2, 1)
_UNIT = float(1 << 48)


def document_size(text: Column) -> Column:
    """Number of words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = DEFAULT_WEIGHTS, max_repeats: int = 3
) -> DataFrame:
    """``(source, source_size, target, rate)`` from ``(source, size)`` rows.

    Sources by code point, null last, weigh ``weights``, repeating.  A target is
    ``min(cap, level * weight)`` with ``cap = max_repeats * source_size``, where the one
    ``level`` makes the targets add up to all sizes: what sharing the excess again and
    again ends in.  In the order of ``cap / weight`` the sources that reach their cap come
    first, so running sums give the level.  The windows run over one row per source.
    """
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = table.withColumn(
        "weight", F.element_at(cycle, ((rank - 1) % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # the first source whose cap holds its share gives the level; later ones give less
    fits = F.when(level * F.col("weight") <= F.col("cap"), level)
    leveled = weighed.withColumn("fits", fits).withColumn("level", F.max("fits").over(everything))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(
        F.least("cap", F.col("level") * F.col("weight"))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(
        F.lit(0.0)
    )
    return leveled.withColumn("target", target).select(
        "source", "source_size", "target", rate.alias("rate")
    )


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from the seed and the id; a null id draws as the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(_UNIT)


def copies_of(rate: Column, doc_id: Column, seed: str) -> Column:
    """``floor(rate)`` copies, and one more with the probability of the fraction."""
    extra = (draw(doc_id, seed) < rate - F.floor(rate)).cast("long")
    return F.floor(rate).cast("long") + extra


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = DEFAULT_WEIGHTS,
    max_repeats: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies``, one row per document.

    Sizes are written once, narrow.  The table of rates has one row per source and is
    written too, so the planner broadcasts it while it is small and joins by key else.
    Documents without words have copies as well, but take no words.  Rows with equal ids
    draw alike.  An empty table gives no rows; a source without words has target 0.
    """
    sizes = stage_table(
        narrow(docs, doc_id=id_col, source=source_col, text=text_col).select(
            "doc_id", "source", document_size(F.col("text")).alias("size")
        ),
        "sizes",
    )
    rates = stage_table(source_targets(sizes, weights, max_repeats), "rates")
    renamed = rates.withColumnRenamed("source", "rate_source")
    return sizes.join(renamed, sizes["source"].eqNullSafe(renamed["rate_source"])).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "rate",
        copies_of(F.col("rate"), F.col("doc_id"), seed).alias("copies"),
    )


def mix_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = DEFAULT_WEIGHTS,
    max_repeats: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """The mix itself: every document as often as its source's rate asks, with all columns."""
    sizes = narrow(docs, source=source_col, text=text_col).select(
        "source", document_size(F.col("text")).alias("size")
    )
    rates = stage_table(
        source_targets(sizes, weights, max_repeats).select(
            F.col("source").alias("__rate_source"), F.col("rate").alias("__rate")
        ),
        "rates",
    )
    copies = copies_of(F.col("__rate"), docs[f"`{id_col}`"], seed)
    joined = docs.join(rates, docs[f"`{source_col}`"].eqNullSafe(rates["__rate_source"]))
    repeated = joined.select(
        *[docs[f"`{c}`"] for c in docs.columns],
        F.explode(F.array_repeat(F.lit(1), copies.cast("int"))).alias("__copy"),
    )
    return repeated.drop("__copy")
