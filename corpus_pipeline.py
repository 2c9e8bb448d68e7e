"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import drop_rows, keep_rows
from dialoom.llm.decontaminate import contaminated
from dialoom.llm.exact_dedup import exact_groups
from dialoom.llm.jaccard_join import jaccard_components
from dialoom.llm.language_id import UNKNOWN, language_column, train_language_model
from dialoom.llm.mixing import mix_documents
from dialoom.session import stage_table

#: A document is rejected if its best language is less likely than this.
MIN_LANGUAGE_SCORE = 0.35

CONTENT = "__content"


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: their text has letters and a likely language."""
    model = train_language_model(docs)
    found = language_column(model, docs["text"], spark)
    return docs.filter((found["lang"] != UNKNOWN) & (found["score"] >= MIN_LANGUAGE_SCORE))


def _keyed(docs: DataFrame) -> tuple[DataFrame, Column]:
    """The rows with 128 bits of hash over all columns, and an order over them.

    The order is the id, null last, then the hashes.  Rows that share both hashes are taken
    for repeated, so any of them may stand for the others and the rows need not be written
    once more to be numbered.
    """
    columns = [docs[f"`{c}`"] for c in docs.columns]
    hashed = F.xxhash64(*columns)
    # a hash leaves nulls out, so where they are goes into the other one
    other = F.xxhash64(F.lit(1), *[x for c in columns for x in (c.isNull(), c)])
    rows = docs.withColumn(CONTENT, F.concat_ws(":", F.hex(hashed), F.hex(other)))
    order = F.struct(
        rows["doc_id"].isNull().alias("no_id"),
        rows["doc_id"].alias("id"),
        hashed.alias("hash"),
        rows[CONTENT].alias("content"),
    )
    return rows, order


def _without(rows: DataFrame, lost: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows but for those ``lost``, and one of each of those ``repeated``."""
    out = drop_rows(rows, lost.unionByName(repeated), CONTENT)
    if not repeated.isEmpty():
        once = keep_rows(rows, repeated, CONTENT, "left_semi").dropDuplicates([CONTENT])
        out = out.unionByName(once)
    return out.drop(CONTENT)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest original, then the smallest id.

    Rows with one id, or without any, are told apart, and of repeated rows one stays.
    """
    rows, order = _keyed(docs)
    groups = exact_groups(rows.select(order.alias("key"), "text"), id_col="key")
    found = groups.groupBy(F.col("doc_id.content").alias(CONTENT), "kept").count()
    found = stage_table(found.filter(~F.col("kept") | (F.col("count") > 1)), "exact")
    return _without(
        rows, found.filter(~F.col("kept")).select(CONTENT), found.filter("kept").select(CONTENT)
    )


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: the smallest id, null last.

    Texts without words are near to nothing and stay, repeated or not.
    """
    rows, order = _keyed(docs)
    found = jaccard_components(rows, id_col=CONTENT).filter("n_shingles > 0")
    counted = found.groupBy(F.col("doc_id").alias(CONTENT), "component_id").count()
    names = rows.select(CONTENT, order.alias("key")).distinct()
    parts = stage_table(counted.join(names, CONTENT), "components")
    kept = parts.groupBy("component_id").agg(F.min("key")["content"].alias("kept"))
    judged = parts.join(kept, "component_id").withColumn("stays", F.col(CONTENT) == F.col("kept"))
    judged = stage_table(judged.filter("not stays or count > 1").select(CONTENT, "stays"), "judged")
    return _without(
        rows, judged.filter("not stays").select(CONTENT), judged.filter("stays").select(CONTENT)
    )


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of the benchmark, each row judged by its own text."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    rows, _ = _keyed(docs)
    found = contaminated(rows, benchmark, id_col=CONTENT, short_items=True)
    lost = stage_table(found.select("doc_id").distinct(), "leaked")
    return drop_rows(rows, lost, CONTENT).drop(CONTENT)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents repeated by the rates of their sources."""
    return mix_documents(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("decontaminate", benchmark_stage),
    ("mix_sources", mix_stage),
]

#: A trained classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in their order over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
