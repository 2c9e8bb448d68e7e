"""Exact and near duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.functions import vectors as V
from dialoom.operators.cosine import DEFAULT_TILE_ROWS, earliest_partners
from dialoom.session import stage_table

_COPIES_PER_SALT = 100_000


def content_key(column: str = "conversation"):
    """Hash of the message list; other fields do not take part in the comparison."""
    return F.unhex(F.sha2(F.to_json(F.col(column)), 256))


def drop_exact_duplicates(df: DataFrame, column: str = "conversation") -> DataFrame:
    """Keep the first record, by size and id, of each message list.

    The aggregate is computed on hashes and ids only and combines on the map side, so
    a conversation with billions of copies reaches the shuffle as one row per task.  The
    lost ids are written, narrow; the full rows are held against them, and while those
    are few the planner leaves the full rows where they are.
    """
    keyed = df.select(content_key(column).alias("_key"), "nbytes", "conv_id")
    firsts = keyed.groupBy("_key").agg(
        F.min(F.struct("nbytes", "conv_id")).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    repeated = firsts.where("_n > 1").select("_key", F.col("_first.conv_id").alias("_kept"))
    lost = keyed.join(repeated, "_key").where(F.col("conv_id") != F.col("_kept"))
    return df.join(stage_table(lost.select("conv_id"), "lost"), "conv_id", "left_anti")


def _distinct_vectors(df: DataFrame) -> DataFrame:
    """One row per bin and vector: the earliest holder, and how many there are."""
    return (
        df.select("bin", "nbytes", "conv_id", V.l2_normalize(F.col("embedding")).alias("unit"))
        .where(F.col("unit").isNotNull())
        .groupBy("bin", "unit")
        .agg(
            F.min(F.struct("nbytes", "conv_id")).alias("first"),
            F.count(F.lit(1)).alias("holders"),
        )
        .select("bin", "unit", "first.nbytes", "first.conv_id", "holders")
    )


def _first_partners(vectors: DataFrame, threshold: float, tile_rows: int) -> DataFrame:
    """Earliest partner of every distinct vector that has an earlier one in its bin."""
    return earliest_partners(vectors.withColumn("late", F.lit(True)), threshold, tile_rows)[0]


def _without_kept_neighbour(vectors: DataFrame, threshold: float, tile_rows: int) -> DataFrame:
    """Ids of the lexicographically first maximal independent set of the graph of near pairs.

    In each round a vector asks for its earliest neighbour among those that are kept or
    undecided.  Without one it is kept; if that one is kept it is dropped; else it waits.
    The earliest undecided vector always decides, so the rounds end, and each is a search
    for the undecided only.
    """
    state = vectors.select("conv_id", F.lit(True).alias("late"))
    while True:
        rows = stage_table(vectors.join(state, "conv_id"), "undecided")
        partners = earliest_partners(rows, threshold, tile_rows)[0]
        asked = rows.select("conv_id", "late").join(
            partners.select("conv_id", "partner_id"), "conv_id", "left"
        )
        # a row is kept if it was, or if nobody stands before it
        status = stage_table(
            asked.withColumn("kept", ~F.col("late") | F.col("partner_id").isNull()), "status"
        )
        keepers = status.where("kept").select(F.col("conv_id").alias("partner_id"))
        waiting = stage_table(
            status.where("NOT kept").join(keepers, "partner_id", "left_anti").select("conv_id"),
            "waiting",
        )
        kept = status.where("kept").select("conv_id")
        if waiting.isEmpty():
            return kept
        state = kept.withColumn("late", F.lit(False)).unionByName(
            waiting.withColumn("late", F.lit(True))
        )


def duplicate_pairs(df: DataFrame, threshold: float, tile_rows: int = DEFAULT_TILE_ROWS) -> DataFrame:
    """``(conv_id, partner_id)`` for each record with an earlier record of its bin above
    the threshold, and the earliest such record.

    One row per duplicate.  The list of all pairs grows with the square of a group of
    copies; the earliest partner is what decides, and it is found over all pairs.
    Needs ``conv_id``, ``nbytes``, ``bin`` and ``embedding``.
    """
    vectors = stage_table(_distinct_vectors(df), "vectors")
    partners = _first_partners(vectors, threshold, tile_rows)
    heads = vectors.join(partners, "conv_id", "left")
    of_heads = heads.where(F.col("partner_id").isNotNull()).select("conv_id", "partner_id")
    # further holders of a vector: the head's partner is theirs too, else the head
    # a vector with many holders is cut by salts, by their number
    salts = F.floor(F.col("holders") / _COPIES_PER_SALT) + 1
    groups = heads.where(
        (F.col("holders") > 1) & (V.dot(F.col("unit"), F.col("unit")) > threshold)
    ).select(
        "bin",
        F.xxhash64("unit").alias("unit_key"),
        "unit",
        salts.alias("salts"),
        F.col("conv_id").alias("head_id"),
        F.coalesce("partner_id", "conv_id").alias("partner_id"),
    )
    # the few vectors of many salts, by their key: all others have one
    spread = stage_table(
        groups.where("salts > 1").groupBy("unit_key").agg(F.max("salts").alias("key_salts")),
        "copy-salts",
    )
    groups = (
        groups.join(spread, "unit_key", "left")
        .withColumn("key_salts", F.coalesce("key_salts", F.lit(1)))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("key_salts") - 1)))
        .drop("salts", "key_salts")
    )
    copies = (
        df.select("bin", "conv_id", V.l2_normalize(F.col("embedding")).alias("unit"))
        .withColumn("unit_key", F.xxhash64("unit"))
        .join(spread, "unit_key", "left")
        .withColumn(
            "salt",
            F.pmod(F.xxhash64("conv_id"), F.coalesce("key_salts", F.lit(1))),
        )
        .drop("key_salts")
        .join(groups, ["bin", "unit_key", "unit", "salt"])
        .where(F.col("conv_id") != F.col("head_id"))
        .select("conv_id", "partner_id")
    )
    return of_heads.unionByName(copies)


def near_duplicates(
    df: DataFrame,
    threshold: float,
    tile_rows: int = DEFAULT_TILE_ROWS,
    survivors: str = "unmatched",
) -> DataFrame:
    """Drop records that are near an earlier one (by size and id) of the same bin: cosine
    similarity above the threshold.

    With ``survivors="unmatched"`` any earlier record counts, dropped ones too.  With
    ``"independent"`` only a record that stays can drop another one, so of a chain whose ends
    are apart both ends may stay, and each dropped record has a near one that stays.

    Copies of a vector share the fate of their head and never meet each other.  A zero
    vector, or one without embedding, has no partner and stays.
    """
    if survivors not in ("unmatched", "independent"):
        raise ValueError(f"unknown rule of survivors: {survivors}")
    vectors = stage_table(_distinct_vectors(df), "vectors")
    alike = V.dot(F.col("unit"), F.col("unit")) > threshold
    if survivors == "independent":
        staying = _without_kept_neighbour(vectors, threshold, tile_rows)
        heads = vectors.where(alike).join(staying, "conv_id", "left_semi").select("conv_id")
    else:
        partners = _first_partners(vectors, threshold, tile_rows)
        heads = vectors.where(alike).join(partners, "conv_id", "left_anti").select("conv_id")
    flagged = df.withColumn("_unit", V.l2_normalize(F.col("embedding")))
    alone = ~F.coalesce(V.dot(F.col("_unit"), F.col("_unit")) > threshold, F.lit(False))
    marked = flagged.join(heads.withColumn("_head", F.lit(True)), "conv_id", "left")
    return marked.where(alone | F.col("_head")).drop("_unit", "_head")
