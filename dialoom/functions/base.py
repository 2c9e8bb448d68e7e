"""Small building blocks shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.fixed_values import PYTHON_WHITESPACE

# Python's white space as a regular-expression class
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    A plain expression used inside a lambda is evaluated again for every element;
    a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Remove white space at both ends, by Python's idea of white space.

    ``trim`` with a list of characters walks over the whole text, so it is called only
    if the first or last character is in the list.
    """
    space = F.lit(PYTHON_WHITESPACE)

    def stripped(v: Column) -> Column:
        outer = F.contains(space, F.left(v, F.lit(1))) | F.contains(space, F.right(v, F.lit(1)))
        return F.when(outer, F.trim(v, space)).otherwise(v)

    return let(text, stripped)


def refine(
    df: DataFrame, column: str, value: Column, keep: Callable[[Column], Column]
) -> DataFrame:
    """Replace ``column`` by ``value`` and keep the rows for which ``keep(value)`` is true.

    A filter above a projection is pushed below it, with the projected expression copied
    into it, so that the work is done once more for every condition.  Exploding an array
    of one or no element computes the value once and filters in the same step.
    """
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(F.filter(F.array(value), keep)).alias(column))


def words(text: Column) -> Column:
    """Split on runs of white space; no empty strings."""
    return F.filter(F.split(text, WHITESPACE_CLASS + "+"), lambda t: t != "")


def order_hash(seed: int | str, *parts: Column) -> Column:
    """Seeded, partition-independent replacement for a random number."""
    text = [F.lit(f"{seed}")]
    for part in parts:
        text += [F.lit(":"), part.cast("string")]
    return F.md5(F.concat(*text))


def hash_choice(n: Column, seed: int | str, *parts: Column) -> Column:
    """Seeded choice of one of ``n``: 0 … n-1."""
    head = F.substring(order_hash(seed, *parts), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), n.cast("bigint"))


def run_lengths(values: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Runs of neighbouring elements as ``array<struct<start, length>>``.

    ``same(previous, current)`` says whether an element continues the run before it.
    Linear in the number of elements.
    """

    def starts(v: Column) -> Column:
        marks = F.transform(
            v,
            lambda x, i: F.when(
                (i > 0) & F.coalesce(same(F.get(v, i - 1), x), F.lit(False)), F.lit(None)
            ).otherwise(i),
        )
        return F.filter(marks, lambda i: i.isNotNull())

    def spans(v: Column) -> Column:
        return let(
            starts(v),
            lambda s: F.transform(
                s,
                lambda first, k: F.struct(
                    first.alias("start"),
                    (F.coalesce(F.get(s, k + 1), F.size(v)) - first).alias("length"),
                ),
            ),
        )

    return let(values, spans)
