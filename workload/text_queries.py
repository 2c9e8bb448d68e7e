"""Text cleaning and text predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialoom.fixed_values import CODE_POINTS, GPT
from dialoom.functions import messages as M
from dialoom.functions import text as T
from dialoom.functions.base import strip
from dialoom.operators import clean as C
from workload import common as W
from workload.registry import query

# phrase -> alternatives; the second phrase is in an alternative of the first, the third
# hits inside words
SWAPS = {
    "the": ("That one", "a quiet und"),
    "und": ("as well as", "plus", "And"),
    "eau": ("water", "l'onde"),
}


def _answers(change: str) -> str:
    return f"""WITH {W.SQL_MSGS}
    {W.LONG} FROM (SELECT conv_id, pos, role,
      CASE WHEN role = 'gpt' THEN {change} ELSE value END AS value FROM msgs)"""


def _map(t, change, roles=None):
    df = W.with_roles(W.raw(t))
    return W.rows(
        df.withColumn("conversation", M.map_values(F.col("conversation"), change, roles))
    )


@query("strip_phrases", _answers(W.sql_strip_phrases("value")))
def strip_phrases(t):
    return _map(t, lambda v: T.strip_phrases(v, W.STRIP_WORDS), [GPT])


@query("cut_at_marker", _answers(W.sql_cut_markers("value")))
def cut_at_marker(t):
    return _map(t, lambda v: T.cut_at_marker(v, W.CUT_WORDS), [GPT])


# one word per line, so that some lines hold nothing but a header word
_LINES = "replace(value, ' ', chr(10))"


@query("cut_reference_sections", _answers(W.sql_cut_sections(_LINES)))
def cut_sections(t):
    return _map(
        t,
        lambda v: T.cut_reference_sections(F.replace(v, F.lit(" "), F.lit("\n")), W.HEADER_WORDS),
        [GPT],
    )


@query(
    "filter_charset_ratio",
    f"""WITH {W.SQL_MSGS} {W.LONG} FROM msgs WHERE conv_id NOT IN (
      SELECT conv_id FROM msgs WHERE role = 'gpt' AND value <> ''
      AND {W.sql_charset_share('value', CODE_POINTS)} < {W.THRESHOLD})""",
)
def charset(t):
    return W.rows(C.filter_charset_ratio(W.with_roles(W.raw(t)), W.OPTIONS))


_REJECT = W.quote("|".join(W.REJECT_WORDS))


@query(
    "drop_rejection_messages",
    f"""WITH {W.SQL_MSGS}, judged AS (
      SELECT *, regexp_matches(value, {_REJECT}) OR regexp_matches(role, {_REJECT}) AS bad
      FROM msgs), spared AS (
      SELECT conv_id, pos, role, {W.sql_strip('value')} AS value FROM judged
      QUALIFY NOT bad OR bool_and(bad) OVER (PARTITION BY conv_id))
    {W.LONG} FROM spared""",
)
def rejection(t):
    return W.rows(C.drop_rejection_messages(W.with_roles(W.raw(t)), W.OPTIONS))


def sql_swap(x: str) -> str:
    """Split at the matches, then join again with the chosen alternatives between."""
    for phrase, alternatives in SWAPS.items():
        listed = "[" + ", ".join(W.quote(a.lower()) for a in alternatives) + "]"
        p = W.quote(f"(?i){phrase}")
        pick = (
            f"{listed}[1 + ('0x' || substr(md5('{W.SEED}:' || conv_id || ':' || pos || "
            f"':{phrase}:' || (i - 1)), 1, 8))::BIGINT % {len(alternatives)}]"
        )
        cased = (
            f"CASE WHEN regexp_matches(m, '^\\p{{Lu}}') "
            f"THEN upper({pick}[1]) || lower({pick}[2:]) ELSE {pick} END"
        )
        x = f"""list_transform([{x}], lambda v: list_reduce(list_transform(
          list_zip(string_split_regex(v, {p}),
                   list_append(list_transform(regexp_extract_all(v, {p}), lambda m, i: {cased}), '')),
          lambda z: z[1] || z[2]), lambda a, b: a || b))[1]"""
    return x


@query(
    "swap_phrases",
    f"""WITH {W.SQL_MSGS} {W.LONG} FROM (
      SELECT conv_id, pos, role, {sql_swap('value')} AS value FROM msgs)""",
)
def swap(t):
    return W.rows(C.swap_phrases(W.with_roles(W.raw(t)), SWAPS, W.SEED))


@query(
    "match_capitalization",
    """SELECT conv_id, turn, CASE WHEN regexp_matches(substr(text, 1, 1), '\\p{Lu}')
       THEN upper(substr(role, 1, 1)) || lower(substr(role, 2)) ELSE role END AS word
       FROM conversations""",
)
def capitalization(t):
    return t("conversations").select(
        "conv_id", "turn", T.match_capitalization(F.col("text"), F.col("role")).alias("word")
    )


@query(
    "truncate_tokens",
    f"""SELECT conv_id, turn, array_to_string(
      list_filter(regexp_split_to_array(text, '{W.SQL_SPACE}+'), lambda w: w <> '')[1:40], ' ')
      AS value FROM conversations""",
)
def truncate(t):
    return t("conversations").select(
        "conv_id", "turn", T.truncate_tokens(F.col("text"), 40).alias("value")
    )


@query(
    "trim_values",
    f"""SELECT conv_id, turn, {W.sql_strip("chr(160) || chr(28) || text || chr(12288) || ' '")}
      AS value FROM conversations""",
)
def trim_values(t):
    padded = F.concat(F.lit("\xa0\x1c"), F.col("text"), F.lit("　 "))
    return t("conversations").select("conv_id", "turn", strip(padded).alias("value"))


@query(
    "conversation_sizes_report",
    f"""WITH {W.SQL_MSGS}, s AS (
      SELECT conv_id, sum({W.SQL_NBYTES}) FILTER (role <> 'system') AS nbytes
      FROM msgs GROUP BY conv_id)
    SELECT count(*) AS records, CAST(sum(nbytes) AS BIGINT) AS total_nbytes,
      CAST(min(nbytes) AS BIGINT) AS min_nbytes, CAST(max(nbytes) AS BIGINT) AS max_nbytes
    FROM s""",
)
def sizes_report(t):
    return W.sized(t).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("nbytes").alias("total_nbytes"),
        F.min("nbytes").alias("min_nbytes"),
        F.max("nbytes").alias("max_nbytes"),
    )
