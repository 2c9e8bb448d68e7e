"""Retrieval documents of conversations and the table that stores them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dialoom.functions import documents as D
from dialoom.functions import messages as M


def build_documents(df: DataFrame) -> DataFrame:
    """``(conv_id, id, system_prompt, human, gpt, term_frequencies, document_length)``
    and ``embedding`` if there is one.  Narrow."""
    m = F.col("conversation")
    texts = df.select(
        "conv_id",
        M.system_prompt_column(m).alias("system_prompt"),
        M.question_text(m).alias("human"),
        M.answer_text(m).alias("gpt"),
        *(["embedding"] if "embedding" in df.columns else []),
    )
    tokens = D.document_tokens(F.col("system_prompt"), F.col("human"), F.col("gpt"))
    counted = texts.withColumn("_tokens", tokens).select(
        *texts.columns,
        D.term_frequencies(F.col("_tokens")).alias("term_frequencies"),
        F.size("_tokens").alias("document_length"),
    )
    document = F.struct(
        "system_prompt", "human", "gpt", "term_frequencies", "document_length"
    )
    return counted.withColumn("id", D.document_id(document))


def new_documents(documents: DataFrame, stored: DataFrame) -> DataFrame:
    """Documents whose id is not stored, each id once: the one of the smallest ``conv_id``.

    Ids decide; the documents follow in one join on the id and its holder.
    """
    chosen = (
        documents.select("id", "conv_id")
        .groupBy("id")
        .agg(F.min("conv_id").alias("conv_id"))
        .join(stored.select("id"), "id", "left_anti")
    )
    return documents.join(chosen, ["id", "conv_id"], "left_semi").dropDuplicates(
        ["id", "conv_id"]
    )


def upsert_documents(documents: DataFrame, path: str) -> int:
    """Append the documents that the Parquet table at ``path`` does not hold; returns
    how many there were.  A second run with the same input adds none.

    The rows are counted while they are written: neither table is read for it.
    """
    spark = documents.sparkSession
    documents.where(F.lit(False)).write.mode("append").parquet(path)
    stored = spark.read.schema(documents.schema).parquet(path)
    added = Observation()
    new_documents(documents, stored).observe(added, F.count(F.lit(1)).alias("n")).write.mode(
        "append"
    ).parquet(path)
    return added.get["n"]
