"""Inputs shared by the queries, and the same inputs as SQL in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.config import PreprocessOptions
from dialoom.fixed_values import DEFAULT_SYSTEM_PROMPT, PYTHON_WHITESPACE
from dialoom.operators.clean import clean, normalize
from dialoom.functions import messages as M
from dialoom.plans.curate import message_rows
from dialoom.sources.records import assemble_conversations
from workload.registry import Tables

# Lists of words that occur in the given texts, so that every rule fires.
STRIP_WORDS = ("the ", "queeux", " und ", "of", "Le ")
CUT_WORDS = (" nicht ", " with ", " que ")
HEADER_WORDS = ("the", "un", "in", "der")
REJECT_WORDS = ("thatha", "zuver", "Qu[aei]")
THRESHOLD = 0.93
MAX_NBYTES = 5000
SEED = 7

OPTIONS = PreprocessOptions(
    strip_phrases=STRIP_WORDS,
    cut_markers=CUT_WORDS,
    section_headers=HEADER_WORDS,
    rejection_phrases=REJECT_WORDS,
    charset_threshold=THRESHOLD,
    max_nbytes=MAX_NBYTES,
)


# ---- Spark side ------------------------------------------------------------------
def raw(t: Tables) -> DataFrame:
    """The conversations as raw records."""
    return assemble_conversations(t("conversations"))


def mixed_rows(t: Tables) -> DataFrame:
    """Every message with metadata; some turns are a tool's and some roles repeat."""
    n = F.length("text")
    return t("conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "system", "system")
        .when(n % 5 == 0, "tool")
        .when(n % 7 == 0, "user")
        .otherwise(F.col("role"))
        .alias("role"),
        "text",
        F.when(F.col("turn") % 2 == 0, F.concat(F.lit("t"), F.col("turn"))).alias("tag"),
        (n % 3).cast("string").alias("level"),
    )


def mixed(t: Tables) -> DataFrame:
    return assemble_conversations(
        mixed_rows(t),
        fields={"role": "role", "content": "text", "tag": "tag", "level": "level"},
    )


def with_roles(df: DataFrame) -> DataFrame:
    """Raw records with plain messages: keys renamed, roles mapped, nothing else."""
    return df.withColumn(
        "conversation",
        M.project_messages(M.map_roles(M.rename_message_keys(F.col("conversation")))),
    )


def normalized(df: DataFrame) -> DataFrame:
    return normalize(df, DEFAULT_SYSTEM_PROMPT)


def cleaned(t: Tables) -> DataFrame:
    """Clean, sized records."""
    return clean(raw(t), OPTIONS)


def sized(t: Tables) -> DataFrame:
    """``conv_id`` and ``nbytes`` of every conversation."""
    from dialoom.operators.clean import with_nbytes

    return with_nbytes(with_roles(raw(t))).select("conv_id", "nbytes")


rows = message_rows


# ---- SQL side --------------------------------------------------------------------
def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_strip(x: str) -> str:
    return f"trim({x}, {quote(PYTHON_WHITESPACE)})"


SQL_MSGS = """
msgs AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
         CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS role,
         text AS value, CAST(NULL AS VARCHAR) AS tag, CAST('None' AS VARCHAR) AS level
  FROM conversations)"""

SQL_MIXED = """
msgs AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
         CASE WHEN role = 'system' THEN 'system' WHEN length(text) % 5 = 0 THEN 'tool'
              WHEN length(text) % 7 = 0 THEN 'human' WHEN role = 'user' THEN 'human'
              ELSE 'gpt' END AS role,
         text AS value,
         CASE WHEN turn % 2 = 0 THEN 't' || turn ELSE 'None' END AS tag,
         CAST(length(text) % 3 AS VARCHAR) AS level
  FROM conversations)"""

# Both keys are on every message: tag before level; the last value of the second group
# of roles wins, else the last of the first.
SQL_META = """
meta_last AS (
  SELECT conv_id,
         coalesce(max_by(tag, pos) FILTER (role IN ('human', 'gpt')),
                  max_by(tag, pos) FILTER (role NOT IN ('system', 'human', 'gpt'))) AS tag,
         coalesce(max_by(level, pos) FILTER (role IN ('human', 'gpt')),
                  max_by(level, pos) FILTER (role NOT IN ('system', 'human', 'gpt'))) AS level
  FROM msgs GROUP BY conv_id),
meta AS (
  SELECT conv_id, tag, level,
         concat_ws(', ', CASE WHEN tag <> 'None' THEN 'tag: ' || tag END,
                         CASE WHEN level <> 'None' THEN 'level: ' || level END) AS prompt
  FROM meta_last)"""

_D = quote(DEFAULT_SYSTEM_PROMPT)
SQL_SYSTEM = f"""
heads AS (
  SELECT m.conv_id, m.role = 'system' AS has_system,
         CASE WHEN m.role = 'system' THEN {sql_strip('m.value')} ELSE '' END AS old,
         meta.prompt
  FROM msgs m JOIN meta USING (conv_id) WHERE m.pos = 0),
full_msgs AS (
  SELECT conv_id, 0 AS pos, 'system' AS role,
         CASE WHEN old <> ''
              THEN coalesce(nullif(trim(old || ', ' || prompt, ', '), ''), {_D})
              ELSE coalesce(nullif(prompt, ''), {_D}) END AS value
  FROM heads
  UNION ALL
  SELECT m.conv_id, m.pos + CASE WHEN h.has_system THEN 0 ELSE 1 END, m.role, m.value
  FROM msgs m JOIN heads h USING (conv_id)
  WHERE NOT (h.has_system AND m.pos = 0))"""

SQL_MERGE = """
said AS (
  SELECT conv_id, bool_or(role = 'human' AND value <> '') AS has_human,
         bool_or(role = 'gpt' AND value <> '') AS has_gpt
  FROM full_msgs GROUP BY conv_id),
numbered AS (
  SELECT f.*, CASE WHEN s.has_human AND s.has_gpt AND f.role IN ('human', 'gpt')
                    AND f.role = lag(f.role) OVER (PARTITION BY f.conv_id ORDER BY f.pos)
               THEN 0 ELSE 1 END AS opens
  FROM full_msgs f JOIN said s USING (conv_id)),
runs AS (
  SELECT *, sum(opens) OVER (PARTITION BY conv_id ORDER BY pos) - 1 AS run FROM numbered),
merged AS (
  SELECT conv_id, CAST(run AS BIGINT) AS pos, any_value(role) AS role,
         string_agg(value, ' ' ORDER BY pos) AS value
  FROM runs GROUP BY conv_id, run)"""

SQL_ORDER = """
ordered AS (
  SELECT conv_id,
         NOT bool_or(role = 'gpt' AND coalesce(before, '') <> 'human') AS ok
  FROM (SELECT conv_id, role, lag(role) OVER (PARTITION BY conv_id ORDER BY pos) AS before
        FROM merged) GROUP BY conv_id)"""

SQL_TAIL = """
tails AS (SELECT conv_id, max(pos) AS last_pos, max_by(role, pos) AS last_role
          FROM merged GROUP BY conv_id),
trimmed AS (
  SELECT m.* FROM merged m JOIN tails t USING (conv_id)
  WHERE NOT (t.last_role = 'human' AND m.pos = t.last_pos))"""

SQL_VALID = """
valid AS (
  SELECT t.* FROM trimmed t JOIN ordered o USING (conv_id) JOIN said s USING (conv_id)
  WHERE o.ok AND s.has_human AND s.has_gpt)"""

VALID = ",".join(
    [SQL_MSGS, SQL_META, SQL_SYSTEM, SQL_MERGE, SQL_ORDER, SQL_TAIL, SQL_VALID]
)
VALID_MIXED = ",".join(
    [SQL_MIXED, SQL_META, SQL_SYSTEM, SQL_MERGE, SQL_ORDER, SQL_TAIL, SQL_VALID]
)


def sql_strip_phrases(x: str, phrases=STRIP_WORDS) -> str:
    for p in phrases:
        x = sql_strip(f"replace({x}, {quote(p)}, '')")
    return x


def sql_cut_markers(x: str, markers=CUT_WORDS) -> str:
    """Nested CASE would repeat its input; markers are cut one select after another."""
    for m in markers:
        x = (
            f"list_transform([{x}], lambda v: CASE WHEN contains(v, {quote(m)}) "
            f"THEN {sql_strip(f'split_part(v, {quote(m)}, 1)')} ELSE v END)[1]"
        )
    return x


SQL_SPACE = "[" + "".join(
    {"\t": "\\t", "\n": "\\n", "\r": "\\r"}.get(c, f"\\x{{{ord(c):x}}}")
    for c in PYTHON_WHITESPACE
) + "]"


def sql_cut_sections(x: str, headers=HEADER_WORDS) -> str:
    pattern = quote(f"(?im)^{SQL_SPACE}*({'|'.join(headers)}){SQL_SPACE}*\\n")
    return (
        f"CASE WHEN regexp_matches({x}, {pattern}) "
        f"THEN {sql_strip(f'string_split_regex({x}, {pattern})[1]')} ELSE {x} END"
    )


def sql_charset_share(x: str, points) -> str:
    listed = "".join(f"\\x{{{p:x}}}" for p in points)
    kept = f"length(regexp_replace({x}, '[^\\x00-\\x7f{listed}]', '', 'g'))"
    return f"{kept}::DOUBLE / length({x})"


SQL_NBYTES = "strlen(to_json({'from': role, 'value': value})::VARCHAR) + 3"


def sql_preprocess(valid: str = VALID) -> str:
    """CTEs up to ``done(conv_id, pos, role, value, nbytes)``."""
    strip = sql_cut_markers(sql_strip_phrases("value"))
    share = sql_charset_share("value", OPTIONS.code_points)
    reject = quote("|".join(REJECT_WORDS))
    return f"""{valid},
stripped AS (
  SELECT conv_id, pos, role, CASE WHEN role = 'gpt' THEN {strip} ELSE value END AS value
  FROM valid),
foreign_convs AS (
  SELECT DISTINCT conv_id FROM stripped
  WHERE role = 'gpt' AND value <> '' AND {share} < {THRESHOLD}),
native AS (SELECT * FROM stripped WHERE conv_id NOT IN (SELECT conv_id FROM foreign_convs)),
cut AS (
  SELECT conv_id, pos, role,
         CASE WHEN role = 'gpt' THEN {sql_cut_sections('value')} ELSE value END AS value
  FROM native),
sizes AS (
  SELECT conv_id, CAST(coalesce(sum({SQL_NBYTES}) FILTER (role <> 'system'), 0) AS BIGINT)
         AS nbytes
  FROM cut GROUP BY conv_id),
capped AS (SELECT c.*, s.nbytes FROM cut c JOIN sizes s USING (conv_id)
           WHERE s.nbytes <= {MAX_NBYTES}),
judged AS (
  SELECT *, regexp_matches(value, {reject}) OR regexp_matches(role, {reject}) AS bad FROM capped),
spared AS (
  SELECT conv_id, pos, role, {sql_strip('value')} AS value, nbytes FROM judged
  QUALIFY NOT bad OR bool_and(bad) OVER (PARTITION BY conv_id)),
keys AS (
  SELECT conv_id, any_value(nbytes) AS nbytes,
         string_agg(role || chr(1) || value, chr(2) ORDER BY pos) AS key
  FROM spared GROUP BY conv_id),
firsts AS (
  SELECT conv_id FROM keys
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY nbytes, conv_id) = 1),
both_roles AS (
  SELECT conv_id FROM spared GROUP BY conv_id
  HAVING bool_or(role = 'human') AND bool_or(role = 'gpt')),
done AS (
  SELECT * FROM spared
  WHERE conv_id IN (SELECT conv_id FROM firsts)
    AND conv_id IN (SELECT conv_id FROM both_roles))"""


LONG = """SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY pos) - 1
  AS BIGINT) AS pos, role, value"""
