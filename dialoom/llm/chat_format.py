"""Chat formatting: collapse cumulative snapshots, then render."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialoom.llm.common import narrow
from dialoom.session import stage_table

TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str):
    """Turns with their place in the conversation and the rolling hash up to them."""
    rows = narrow(conversations, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    place = F.row_number().over(
        Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    )
    rolling = Window.partitionBy("conv_id").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # a hash tagged with the place makes the running XOR depend on the order; two
    # independent ones give 128 bits
    numbered = rows.select("conv_id", role.alias("role"), text.alias("text"), place.alias("place"))
    tagged = numbered.withColumns(
        {
            "h1": F.xxhash64("place", "role", "text"),
            "h2": F.xxhash64(F.lit("second"), "text", "role", "place"),
        }
    )
    return tagged.select(
        "conv_id",
        "place",
        "role",
        "text",
        F.bit_xor("h1").over(rolling).alias("p1"),
        F.bit_xor("h2").over(rolling).alias("p2"),
    )


def maximal_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Turns ``(conv_id, place, role, text)`` of the conversations that prefix no longer one.

    Of equal conversations the smallest id stays.  The prefixes are narrow rows of hashes;
    distinct ones are combined on the map side, so a first turn shared by a third of all
    conversations is one row per task.  Null roles and texts count as empty, rows with a
    null conversation form one conversation, null turns come last, equal turn numbers are
    ordered by role and text.
    """
    turns = stage_table(
        _turns(conversations, conv_col, turn_col, role_col, text_col), "turns"
    )
    last = turns.groupBy("conv_id").agg(
        F.max("place").alias("place"), F.max_by(F.struct("p1", "p2"), "place").alias("p")
    )
    whole = last.select("conv_id", "place", F.col("p.p1").alias("p1"), F.col("p.p2").alias("p2"))
    whole = stage_table(whole, "whole")
    kept = whole.groupBy("place", "p1", "p2").agg(
        F.min(F.struct(F.col("conv_id").isNull(), "conv_id"))["conv_id"].alias("conv_id")
    )
    # a prefix of a longer conversation: all but the last turn of each
    ends = whole.select(F.col("conv_id").alias("end_id"), F.col("place").alias("end"))
    proper = (
        turns.select("conv_id", "place", "p1", "p2")
        .join(ends, F.col("conv_id").eqNullSafe(F.col("end_id")) & (F.col("place") < F.col("end")))
        .select("place", "p1", "p2")
        .distinct()
    )
    maximal = kept.join(proper, ["place", "p1", "p2"], "left_anti").select(
        F.col("conv_id").alias("kept_id")
    )
    return turns.join(
        maximal, F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi"
    ).select("conv_id", "place", "role", "text")


def render(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, text)``: the turns of each conversation in chat markup."""
    one = F.concat(
        F.lit(TURN_START), F.col("role"), F.lit("\n"), F.col("text"), F.lit(TURN_END + "\n")
    )
    grouped = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", one.alias("line")))).alias("lines")
    )
    return grouped.select(
        "conv_id",
        F.size("lines").cast("long").alias("n_turns"),
        F.array_join(F.col("lines.line"), "").alias("text"),
    )
