"""Audit of filters that interact: what each one removes at every place of every order."""

from __future__ import annotations

import json
from collections.abc import Mapping
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import narrow, words
from dialoom.session import stage_table

#: Letters of more filters than this are refused: the orders grow with the factorial.
MAX_FILTERS = 6


def text_filters() -> dict[str, Column]:
    """Failure conditions over the columns ``text`` (never null) and ``words``.

    A: under 200 words; B: fewer than half of the words are distinct; C: more than 2 % of
    the code points are `A-Z`; D: holds one of ``#$%&*|``.
    """
    text, n_words = F.col("text"), F.size("words")
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < 200,
        "B": 100 * F.size(F.array_distinct("words")) < 50 * n_words,
        "C": 100 * capitals > 2 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _mask(filters: Mapping[str, Column]) -> Column:
    bits = [
        F.when(F.coalesce(fails, F.lit(False)), 1 << bit).otherwise(0)
        for bit, fails in enumerate(filters.values())
    ]
    return sum(bits[1:], bits[0]).cast("int")


def failure_cells(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column] | None = None,
    duplicates: str | None = "E",
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """``part, mask, n, good, toxic``: rows of each part by the set of filters they fail.

    ``filters`` maps a letter to its failure condition over the columns ``text`` (null texts
    are empty) and ``words``, and bit ``i`` of the mask is the ``i``-th letter.  ``duplicates`` adds a last letter: a row
    fails it if its text is that of a row with a smaller id, anywhere in the table.

    Null texts count as empty, null parts as the empty string, a null condition as passed.
    A row without id, and rows that share the smallest id of a text, have no smaller one
    and pass the duplicate filter.  A document is good (toxic) if any label row of its id
    says 1; without labels it is neither.  An empty table has no cells.

    Texts are read once.  The first row of each text is found by a minimum that is combined
    before the shuffle, and looked up by text and id, so copies of one text never meet in
    one task.
    """
    filters = text_filters() if filters is None else filters
    rows = (
        narrow(docs, doc_id=id_col, text=text_col, part=part_col)
        .withColumn("text", F.coalesce("text", F.lit("")))
        .withColumn("words", words(F.col("text")))
        .select(
            "doc_id",
            F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"),
            _mask(filters).alias("mask"),
            F.sha2("text", 256).alias("digest"),
        )
    )
    marks = (
        labels.select("doc_id", "quality", "toxic")
        .groupBy("doc_id")
        .agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
        )
    )
    rows = stage_table(rows, "masks").join(marks, "doc_id", "left")
    counts = [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    ]
    cells = rows.groupBy("part", "mask").agg(*counts)
    if duplicates is None:
        return cells
    # every row fails but the first of each text: those move from one cell to the other
    bit = 1 << len(filters)
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    passing = (
        rows.join(first, ["digest", "doc_id"], "left_semi")
        .unionByName(rows.filter(F.col("doc_id").isNull()))
        .groupBy("part", "mask")
        .agg(*counts)
    )
    failing = cells.unionByName(
        passing.select("part", "mask", *[(-F.col(c)).alias(c) for c in ("n", "good", "toxic")])
    ).withColumn("mask", F.col("mask").bitwiseOR(F.lit(bit)))
    return (
        failing.unionByName(passing)
        .groupBy("part", "mask")
        .agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
        .filter(F.col("n") > 0)
    )


def prefix_steps(masks: DataFrame, letters: str) -> DataFrame:
    """``prefix, letter, step, mask, kept, removed, redundant, unique_fails``: for every
    sequence of different letters and every mask, what its last filter does to a row with
    that mask (0 or 1).

    A recursive query extends each prefix with the letters it does not use, joins the mask
    cells and carries the bits applied so far.  It runs over the distinct masks, at most
    ``2 ** n`` for ``n`` letters, so its size does not depend on the data: 10,432 rows for
    five letters.
    """
    if not 0 < len(letters) <= MAX_FILTERS or len(set(letters)) != len(letters):
        raise ValueError(f"1 to {MAX_FILTERS} different letters are needed")
    spark: SparkSession = masks.sparkSession
    choices = json.dumps([{"letter": c, "bit": 1 << i} for i, c in enumerate(letters)])
    walk = spark.sql(
        """
        WITH RECURSIVE walk (prefix, letter, before, bit, step, mask) AS (
          SELECT '', '', 0, 0, 0, mask FROM {cells}
          UNION ALL
          SELECT concat(w.prefix, f.letter), f.letter, w.before | w.bit, f.bit, w.step + 1, c.mask
          FROM walk w JOIN {cells} c ON c.mask = w.mask
          LATERAL VIEW explode(filter(
            from_json(:choices, 'array<struct<letter:string,bit:int>>'),
            l -> instr(w.prefix, l.letter) = 0)) e AS f)
        SELECT prefix, letter, step, mask,
               CAST(mask & (before | bit) = 0 AS INT) AS kept,
               CAST(mask & bit <> 0 AND mask & before = 0 AS INT) AS removed,
               CAST(mask & bit <> 0 AND mask & before <> 0 AS INT) AS redundant,
               CAST(mask = bit AS INT) AS unique_fails
        FROM walk WHERE step > 0""",
        args={"choices": choices},
        cells=masks,
    )
    return walk


def audit_orders(cells: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the letters and step, from the cells of
    ``failure_cells``: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``.

    ``shapley`` is the sum over all orders of what the step's filter removes.  Parts are
    grouped, never collected; each contributes at most ``2 ** n`` cells.
    """
    cells = stage_table(cells, "cells")
    walk = stage_table(prefix_steps(cells.select("mask").distinct(), letters), "walk")

    def total(flag: str, counted: str, name: str) -> Column:
        return F.sum(F.col(flag) * F.col(counted)).alias(name)

    steps = (
        cells.join(walk, "mask")
        .groupBy("part", "prefix", "letter", "step")
        .agg(
            total("kept", "n", "kept"),
            total("removed", "n", "removed"),
            total("redundant", "n", "redundant"),
            total("unique_fails", "n", "unique_fails"),
            total("removed", "good", "good_lost"),
            total("removed", "toxic", "toxic_lost"),
        )
    )
    steps = stage_table(steps, "steps")
    n = len(letters)
    # a prefix of k letters starts (n - k)! orders
    completions = F.get(
        F.array(*[F.lit(factorial(n - k)).cast("long") for k in range(n + 1)]), F.col("step")
    )
    shapley = steps.groupBy("part", "letter").agg(
        F.sum(F.col("removed") * completions).alias("shapley")
    )
    orders = (
        walk.filter(F.col("step") == n)
        .select(F.col("prefix").alias("filter_order"))
        .distinct()
        .select(
            "filter_order",
            F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"),
        )
        .select("filter_order", F.substring("filter_order", F.lit(1), F.col("step")).alias("prefix"))
    )
    return (
        steps.join(shapley, ["part", "letter"])
        .join(orders, "prefix")
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
            "good_lost", "toxic_lost", "shapley",
        )
    )


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column] | None = None,
    duplicates: str | None = "E",
    **columns: str,
) -> DataFrame:
    """``audit_orders`` of the ``failure_cells`` of a table of documents."""
    used = list(text_filters() if filters is None else filters)
    letters = "".join(used) + (duplicates or "")
    return audit_orders(failure_cells(docs, labels, filters, duplicates, **columns), letters)
