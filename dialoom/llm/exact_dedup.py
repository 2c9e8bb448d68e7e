"""Exact duplicates through an extendible-hash index on shared files."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialoom.llm.common import narrow, without_spaces
from dialoom.session import stage_table

_DOUBLINGS = 6  # local depths looked at below the deepest possible one


def _directory(keys: DataFrame, capacity: int):
    """Slots of the directory, each with its bucket and the bucket's local depth.

    The directory starts with so few slots that every bucket can be overfull, and is
    doubled ``_DOUBLINGS`` times at most.  At each depth an overfull bucket is split on
    the next bit of the key; a bucket that fits keeps its depth, so several slots may
    point to it.  What is still overfull at the last depth chains.
    """
    total = keys.count()
    depth = min(32, max(1, math.ceil(math.log2(max(1, total / capacity))) + _DOUBLINGS // 2))
    first = max(1, depth - _DOUBLINGS)
    slots = keys.groupBy(F.shiftrightunsigned("key", 64 - depth).alias("slot")).agg(
        F.count(F.lit(1)).alias("n")
    )
    local = F.lit(depth)
    for d in range(depth - 1, first - 1, -1):
        n = F.sum("n").over(Window.partitionBy(F.shiftright("slot", depth - d)))
        local = F.when(n <= capacity, F.lit(d)).otherwise(local)
    slots = slots.select("slot", local.alias("local_depth"))
    first_slot = F.expr(
        f"shiftleft(shiftright(slot, {depth} - local_depth), {depth} - local_depth)"
    )
    return stage_table(slots.withColumn("bucket", first_slot), "directory"), depth


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 65_536,
    key_bits: int = 64,
) -> DataFrame:
    """Groups of documents that are equal without their white space.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept, text_sha256,
    bucket, chain``.  The row with the most code points stays, then the smallest id.

    * ``entries``: one narrow pass writes key, SHA-256, length and id of every row.
    * ``directory``: buckets over the distinct keys, split by directory doubling.
    * ``texts``: rows are grouped by key and *bytes* of the text, combined on the map
      side, so a text with a third of all rows reaches the shuffle once per task.
    * The index holds one row per text, in files by ranges of slots; the task that owns a
      range numbers the chain of texts that share a key.
    * Every row then looks up its text.  The index is joined, never collected.

    Null and empty texts form one group.  A null id is larger than any other.  Rows with
    equal id and text are the same document: each is reported, with the same decision.
    ``key_bits`` shortens the key, to make collisions in tests.  An empty table gives no
    rows.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    text = without_spaces(F.col("text"))
    key = F.xxhash64("norm").bitwiseAND(F.lit(-1 << (64 - key_bits)).cast("long"))
    entries = stage_table(
        rows.select(
            "doc_id",
            F.coalesce(F.char_length("text"), F.lit(0)).alias("points"),
            text.alias("norm"),
        ).select("doc_id", "points", key.alias("key"), F.sha2("norm", 256).alias("sha")),
        "entries",
    )
    directory, depth = _directory(entries.select("key").distinct(), capacity)
    texts = (
        rows.select(text.alias("norm"))
        .groupBy(key.alias("key"), "norm")
        .agg(F.count(F.lit(1)).alias("n_bytes_equal"))
        .select("key", F.sha2("norm", 256).alias("sha"), "n_bytes_equal")
    )
    best = F.min(F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id"))
    groups = entries.groupBy("key", "sha").agg(
        best["doc_id"].alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    # one fingerprint stands for one text only if the bytes say so
    same = F.when(F.col("n") == F.col("n_bytes_equal"), F.col("n")).otherwise(
        F.raise_error(F.lit("two texts with one fingerprint")).cast("long")
    )
    chained = (
        groups.join(texts, ["key", "sha"])
        .withColumn("slot", F.shiftrightunsigned("key", 64 - depth))
        .join(directory, "slot")
        .repartitionByRange("slot", "key")
        .withColumn("chain", F.row_number().over(Window.partitionBy("slot", "key").orderBy("sha")))
        .select("key", "sha", "keep_id", same.alias("group_size"), "bucket", "local_depth", "chain")
    )
    index = stage_table(chained, "index")
    return entries.join(index, ["key", "sha"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "bucket",
        "chain",
    )
