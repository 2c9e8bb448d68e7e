"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def without_spaces(text: Column) -> Column:
    """``text`` without its white space; null counts as empty."""
    return reduce(
        lambda c, space: F.replace(c, F.lit(space), F.lit("")),
        _SPACES,
        F.coalesce(text, F.lit("")),
    )


def words(text: Column) -> Column:
    """All words, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names, and nothing else."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def keep_rows(df: DataFrame, chosen: DataFrame, id_col: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose id is (``left_semi``) or is not (``left_anti``) in the one
    column of ``chosen``; a null id equals a null id."""
    right = chosen.toDF("__chosen_id")
    return df.join(right, df[f"`{id_col}`"].eqNullSafe(right["__chosen_id"]), how)


def with_flag(df: DataFrame, id_col: str, ids: DataFrame, flag: str) -> DataFrame:
    """``df`` and a column: whether a row's id may be in the one column of ``ids``, never
    false for one that is.  It decides which rows have to be joined, and the join the rest.

    An id sets four of the 64 bits of a word, and four ids at most share a word: 16 bits or
    more per id, within 8 kB and 4 MB.  The words are a broadcast table, so the test is a lookup in the
    task: a test in Python would give each task a second worker beside its operator's.
    """
    bits = min(19, max(10, (ids.count() // 4).bit_length()))

    def word(hashed: Column) -> Column:
        return F.shiftrightunsigned(hashed, 64 - bits)

    def marks(hashed: Column) -> Column:
        places = [F.shiftright(hashed, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(4)]
        one = F.lit(1).cast("long")
        return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, x) for x in places])

    of_id = F.xxhash64(F.col(f"`{ids.columns[0]}`"))
    words = ids.groupBy(word(of_id).alias("__word")).agg(F.bit_or(marks(of_id)).alias("__marks"))
    own = F.xxhash64(F.col(f"`{id_col}`"))
    found = df.join(F.broadcast(words), word(own) == F.col("__word"), "left")
    hit = F.col("__marks").bitwiseAND(marks(own)) == marks(own)
    return found.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("__word", "__marks")


def drop_rows(df: DataFrame, lost: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose id is not in the one column of ``lost``.  Most rows pass without
    a shuffle: only those that may be lost are joined."""
    flagged = with_flag(df, id_col, lost, "__may_be_lost")
    judged = keep_rows(flagged.filter("__may_be_lost"), lost, id_col, "left_anti")
    return flagged.filter("not __may_be_lost").unionByName(judged).drop("__may_be_lost")
