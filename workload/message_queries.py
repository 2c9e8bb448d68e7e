"""Normalisation and validation of messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialoom.fixed_values import GPT, HUMAN
from dialoom.functions import messages as M
from dialoom.operators import clean as C
from workload import common as W
from workload.registry import Tables, query


def _meta(t: Tables):
    m = M.map_roles(M.rename_message_keys(F.col("conversation")))
    return W.mixed(t).select("conv_id", M.collect_metadata(m).alias("metadata"))


@query(
    "assemble_conversations",
    """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
       role, text AS value FROM conversations""",
)
def assemble(t):
    df = W.raw(t)
    return W.rows(df.withColumn("conversation", M.rename_message_keys(F.col("conversation"))))


@query(
    "rename_message_keys",
    """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
       CASE WHEN length(text) % 2 = 0 THEN role ELSE 'from-' || role END AS role,
       CASE WHEN length(text) % 3 = 0 THEN 'old ' || text ELSE text END AS value
       FROM conversations""",
)
def rename(t):
    """Half of the messages have both spellings of a key; the new one wins."""
    df = W.raw(t).withColumn(
        "conversation",
        F.transform(
            "conversation",
            lambda m: F.map_concat(
                F.when(
                    F.length(m["content"]) % 2 == 0,
                    F.create_map(F.lit("role"), m["role"], F.lit("from"), F.lit("x")),
                ).otherwise(F.create_map(F.lit("from"), F.concat(F.lit("from-"), m["role"]))),
                F.when(
                    F.length(m["content"]) % 3 == 0,
                    F.create_map(F.lit("value"), F.concat(F.lit("old "), m["content"])),
                ).otherwise(F.create_map(F.lit("content"), m["content"])),
            ),
        ),
    )
    return W.rows(df.withColumn("conversation", M.rename_message_keys(F.col("conversation"))))


@query("map_roles", f"WITH {W.SQL_MSGS} {W.LONG} FROM msgs")
def roles(t):
    return W.rows(W.with_roles(W.raw(t)))


@query(
    "collect_message_metadata",
    f"""WITH {W.SQL_MIXED},{W.SQL_META}
    SELECT conv_id, 0 AS pos, 'tag' AS key, tag AS value FROM meta WHERE tag IS NOT NULL
    UNION ALL SELECT conv_id, 1, 'level', level FROM meta WHERE level IS NOT NULL""",
)
def metadata(t):
    return _meta(t).select("conv_id", F.posexplode("metadata").alias("pos", "e")).select(
        "conv_id", F.col("pos").cast("bigint").alias("pos"), "e.key", "e.value"
    )


@query(
    "metadata_prompt",
    f"WITH {W.SQL_MIXED},{W.SQL_META} SELECT conv_id, prompt FROM meta",
)
def metadata_text(t):
    return _meta(t).select("conv_id", M.metadata_prompt(F.col("metadata")).alias("prompt"))


@query(
    "upsert_system_prompt",
    f"WITH {W.SQL_MIXED},{W.SQL_META},{W.SQL_SYSTEM} {W.LONG} FROM full_msgs",
)
def upsert(t):
    return W.rows(W.normalized(W.mixed(t)))


@query(
    "upsert_system_prompt_without_metadata",
    f"WITH {W.SQL_MSGS},{W.SQL_META},{W.SQL_SYSTEM} {W.LONG} FROM full_msgs",
)
def upsert_plain(t):
    return W.rows(W.normalized(W.raw(t)))


@query("project_messages", f"WITH {W.SQL_MIXED} {W.LONG} FROM msgs")
def project(t):
    return W.rows(W.with_roles(W.mixed(t)))


@query(
    "has_role_with_value",
    f"""WITH {W.SQL_MIXED}
    SELECT conv_id, CAST(bool_or(role = 'human' AND value <> '') AS INT) AS has_human,
           CAST(bool_or(role = 'gpt' AND value <> '') AS INT) AS has_gpt
    FROM msgs GROUP BY conv_id""",
)
def has_role(t):
    m = F.col("conversation")
    return W.with_roles(W.mixed(t)).select(
        "conv_id",
        M.has_role_with_value(m, HUMAN).cast("int").alias("has_human"),
        M.has_role_with_value(m, GPT).cast("int").alias("has_gpt"),
    )


@query(
    "merge_consecutive_turns",
    f"WITH {W.SQL_MIXED},{W.SQL_META},{W.SQL_SYSTEM},{W.SQL_MERGE} {W.LONG} FROM merged",
)
def merge(t):
    df = W.normalized(W.mixed(t))
    return W.rows(
        df.withColumn("conversation", M.merge_consecutive_turns(F.col("conversation")))
    )


@query(
    "valid_turn_order",
    f"""WITH {W.SQL_MIXED},{W.SQL_META},{W.SQL_SYSTEM},{W.SQL_MERGE},{W.SQL_ORDER}
    SELECT conv_id, CAST(ok AS INT) AS ok FROM ordered""",
)
def turn_order(t):
    m = M.merge_consecutive_turns(F.col("conversation"))
    return W.normalized(W.mixed(t)).select(
        "conv_id", M.valid_turn_order(m).cast("int").alias("ok")
    )


@query(
    "drop_trailing_human",
    f"""WITH {W.SQL_MIXED},{W.SQL_META},{W.SQL_SYSTEM},{W.SQL_MERGE},{W.SQL_TAIL}
    {W.LONG} FROM trimmed""",
)
def trailing(t):
    m = M.merge_consecutive_turns(F.col("conversation"))
    return W.rows(
        W.normalized(W.mixed(t)).withColumn("conversation", M.drop_trailing_human(m))
    )


@query("filter_valid_conversations", f"WITH {W.VALID_MIXED} {W.LONG} FROM valid")
def valid(t):
    return W.rows(C.filter_valid_conversations(W.normalized(W.mixed(t))))


@query(
    "require_both_roles",
    f"""WITH {W.SQL_MIXED} {W.LONG} FROM msgs WHERE conv_id IN (
      SELECT conv_id FROM msgs GROUP BY conv_id
      HAVING bool_or(role = 'human') AND bool_or(role = 'gpt'))""",
)
def both_roles(t):
    return W.rows(C.require_both_roles(W.with_roles(W.mixed(t))))


@query(
    "conversation_nbytes",
    f"""WITH {W.SQL_MSGS}
    SELECT conv_id, CAST(coalesce(sum({W.SQL_NBYTES}) FILTER (role <> 'system'), 0) AS BIGINT)
      AS nbytes FROM msgs GROUP BY conv_id""",
)
def nbytes(t):
    return W.sized(t)


@query(
    "qa_pair_text",
    f"""WITH {W.SQL_MIXED}
    SELECT conv_id,
      'search_query: ' || coalesce(string_agg(value, ' [SEP] ' ORDER BY pos)
         FILTER (role = 'human'), '') AS question,
      'search_query: ' || coalesce(string_agg(value, ' [SEP] ' ORDER BY pos)
         FILTER (role = 'gpt'), '') AS answer
    FROM msgs GROUP BY conv_id""",
)
def qa_text(t):
    m = F.col("conversation")
    return W.with_roles(W.mixed(t)).select(
        "conv_id", M.question_text(m).alias("question"), M.answer_text(m).alias("answer")
    )
