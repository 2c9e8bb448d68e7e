"""Embedding of questions and answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from dialoom.functions import messages as M
from dialoom.functions import text as T
from dialoom.functions import vectors as V
from dialoom.functions.base import let, words

# list of texts -> one vector per text
Embedder = Callable[[Sequence[str]], "np.ndarray"]


def qa_texts(df: DataFrame, max_tokens: int | None = None) -> DataFrame:
    """Add ``question`` and ``answer``, cut to ``max_tokens`` tokens each."""
    q = M.question_text(F.col("conversation"))
    a = M.answer_text(F.col("conversation"))
    if max_tokens is not None:
        q, a = T.truncate_tokens(q, max_tokens), T.truncate_tokens(a, max_tokens)
    return df.withColumn("question", q).withColumn("answer", a)


def hashed_bag(text: Column, dimensions: int) -> Column:
    """Counts of the tokens' md5 buckets: an embedding that needs no model."""
    bucket = F.transform(
        words(text),
        lambda w: F.pmod(
            F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint"), F.lit(dimensions)
        ).cast("int"),
    )

    def counts(tokens: Column) -> Column:
        # sorted buckets: the count of i lies between the first position of i and of i+1
        padded = F.array_sort(
            F.concat(tokens, F.sequence(F.lit(0), F.lit(dimensions)))
        )
        return let(
            padded,
            lambda p: let(
                F.transform(
                    F.sequence(F.lit(0), F.lit(dimensions)),
                    lambda i: F.array_position(p, i),
                ),
                lambda at: F.transform(
                    F.sequence(F.lit(0), F.lit(dimensions - 1)),
                    lambda i: (F.get(at, i + 1) - F.get(at, i) - 1).cast("double"),
                ),
            ),
        )

    return let(bucket, counts)


def embed_hashed(
    df: DataFrame, dimensions: int = 64, max_tokens: int | None = None
) -> DataFrame:
    """Add ``embedding``: hashed question half, then hashed answer half.

    Whole texts count: there is no context window.  ``max_tokens`` is for comparisons with
    a model that has one.
    """
    half = dimensions // 2
    texts = qa_texts(df, max_tokens)
    return texts.withColumn(
        "embedding",
        V.concat_halves(
            hashed_bag(F.col("question"), half), hashed_bag(F.col("answer"), half)
        ),
    ).drop("question", "answer")


def embed_with(
    df: DataFrame,
    make_embedder: Callable[[], Embedder],
    max_tokens: int = 8192,
    batch_rows: int = 64,
) -> DataFrame:
    """Add ``embedding`` by a model, which starts once per worker and task.

    Only the two texts travel to Python.  Rows are sorted by size inside each partition,
    so that a batch holds texts of similar length.
    """
    rows = df.sortWithinPartitions("nbytes") if "nbytes" in df.columns else df

    @F.pandas_udf(t.ArrayType(t.DoubleType()))
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        embed = make_embedder()
        for questions, answers in batches:
            vectors = []
            for start in range(0, len(questions), batch_rows):
                part = slice(start, start + batch_rows)
                q = np.asarray(embed(questions.iloc[part].tolist()), dtype=np.float64)
                a = np.asarray(embed(answers.iloc[part].tolist()), dtype=np.float64)
                vectors.extend(np.concatenate([q, a], axis=1))
            yield pd.Series(vectors, dtype=object)

    texts = qa_texts(rows, max_tokens)
    # not to be run twice for one row
    vector = run.asNondeterministic()(F.col("question"), F.col("answer"))
    return texts.withColumn("embedding", vector).drop("question", "answer")


def with_embeddings(
    df: DataFrame, embed: Callable[[DataFrame], DataFrame], given: str = "qa_pair_embeddings"
) -> DataFrame:
    """Use the vectors in the input if every record has one, else compute all."""
    if given in df.columns:
        complete = df.agg(F.bool_and(F.col(given).isNotNull()).alias("all")).first()
        if complete and complete["all"]:
            return df.withColumn("embedding", V.as_double(F.col(given))).drop(given)
        df = df.drop(given)
    return embed(df)


def mean_pool(tokens: DataFrame, by: str = "conv_id") -> DataFrame:
    """Masked mean of token vectors: ``(by, pos, vector, mask)`` → ``(by, pooled)``.

    One weighted vector aggregate, combined on the map side, so a long text is no hot key
    and no row per vector entry is made; a text whose mask is empty gets zeros.
    """
    weight = F.col("mask").cast("double")
    vector = array_to_vector(V.as_double(F.col("vector")))
    zeros = F.transform(F.first("vector"), lambda _: F.lit(0.0))
    kept = tokens.where(weight > 0)
    pooled = kept.groupBy(by).agg(
        vector_to_array(Summarizer.mean(vector, weight)).alias("_pooled")
    )
    every = tokens.groupBy(by).agg(zeros.alias("_zeros"))
    same = every[by].eqNullSafe(pooled[by])
    return every.join(pooled, same, "left").select(
        every[by], F.coalesce("_pooled", "_zeros").alias("pooled")
    )
