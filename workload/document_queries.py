"""Retrieval documents and their table."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialoom.operators import documents as D
from dialoom.session import new_folder
from workload import common as W
from workload.registry import query

_DOCS = f"""{W.SQL_MSGS}, docs AS (
  SELECT conv_id,
    coalesce(max(value) FILTER (pos = 0 AND role = 'system'), '') AS system_prompt,
    'search_query: ' || coalesce(string_agg(value, ' [SEP] ' ORDER BY pos)
       FILTER (role = 'human'), '') AS human,
    'search_query: ' || coalesce(string_agg(value, ' [SEP] ' ORDER BY pos)
       FILTER (role = 'gpt'), '') AS gpt
  FROM msgs GROUP BY conv_id),
tokens AS (
  SELECT conv_id, unnest(list_filter(regexp_split_to_array(
    system_prompt || ' ' || human || ' ' || gpt, '{W.SQL_SPACE}+'), lambda w: w <> '')) AS term
  FROM docs),
terms AS (SELECT conv_id, term, count(*) AS n FROM tokens GROUP BY ALL),
counted AS (
  SELECT conv_id, map_from_entries(list({{'k': term, 'v': n}} ORDER BY term)) AS tf,
         CAST(sum(n) AS BIGINT) AS len
  FROM terms GROUP BY conv_id),
ids AS (
  SELECT conv_id, sha256(to_json({{'system_prompt': system_prompt, 'human': human,
    'gpt': gpt, 'term_frequencies': tf, 'document_length': len}})::VARCHAR) AS id
  FROM docs JOIN counted USING (conv_id))"""


def documents(t):
    return D.build_documents(W.with_roles(W.raw(t)))


@query("system_prompt_column", f"WITH {_DOCS} SELECT conv_id, system_prompt FROM docs")
def system_prompt(t):
    return documents(t).select("conv_id", "system_prompt")


@query("term_frequencies", f"WITH {_DOCS} SELECT conv_id, term, n FROM terms")
def term_frequencies(t):
    return documents(t).select("conv_id", F.explode("term_frequencies").alias("term", "n")).select(
        "conv_id", "term", F.col("n").cast("bigint").alias("n")
    )


@query("document_length", f"WITH {_DOCS} SELECT conv_id, len AS document_length FROM counted")
def document_length(t):
    return documents(t).select(
        "conv_id", F.col("document_length").cast("bigint").alias("document_length")
    )


@query("document_id", f"WITH {_DOCS} SELECT conv_id, id FROM ids")
def document_id(t):
    return documents(t).select("conv_id", "id")


# what an earlier run stored: the conversations whose first message is not a system one
_STORED = "SELECT conv_id FROM conversations WHERE turn = 0 AND role <> 'system'"


def stored(t):
    first = t("conversations").where("turn = 0 AND role <> 'system'").select("conv_id")
    return W.raw(t).join(first, "conv_id", "left_semi")


@query(
    "new_documents",
    f"WITH {_DOCS} SELECT id FROM ids WHERE conv_id NOT IN ({_STORED})",
)
def new_documents(t):
    old = D.build_documents(W.with_roles(stored(t)))
    return D.new_documents(documents(t), old).select("id")


@query(
    "upsert_vector_store",
    f"""WITH {_DOCS}
    SELECT 'first' AS run, count(*) AS added FROM ids WHERE conv_id IN ({_STORED})
    UNION ALL SELECT 'second', count(*) FROM ids WHERE conv_id NOT IN ({_STORED})
    UNION ALL SELECT 'third', 0
    UNION ALL SELECT 'stored', count(DISTINCT id) FROM ids""",
)
def upsert(t):
    """Part of the documents, then all of them, then all again."""
    path = new_folder(t.spark, "documents")
    some, every = D.build_documents(W.with_roles(stored(t))), documents(t)
    added = [
        ("first", D.upsert_documents(some, path)),
        ("second", D.upsert_documents(every, path)),
        ("third", D.upsert_documents(every, path)),
    ]
    counted = t.spark.createDataFrame(added, "run string, added bigint")
    table = t.spark.read.schema(every.schema).parquet(path)
    return counted.unionByName(
        table.agg(F.countDistinct("id").alias("added")).select(F.lit("stored").alias("run"), "added")
    )
