"""Composed runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.config import CurateOptions, FilterOptions, OutputOptions, RewriteOptions
from dialoom.fixed_values import DEFAULT_CURRENT_PROMPT
from dialoom.functions import messages as M
from dialoom.operators import clean as C
from dialoom.operators.split import stage_counts
from dialoom.plans.curate import curate, report
from dialoom.plans.preprocess import preprocess
from workload import common as W
from workload.registry import Tables, query
from workload.rewrite_queries import make_generator, sql_prompt
from workload.size_queries import sql_balance, sql_segments, sql_split
from workload.source_queries import SQL_LINE
from workload.text_queries import SWAPS, sql_swap
from workload.vector_queries import sql_two_stage


@query(
    "flagship",
    f"""WITH {W.VALID}, s AS (
      SELECT conv_id, count(*) AS n_messages,
        CAST(coalesce(sum({W.SQL_NBYTES}) FILTER (role <> 'system'), 0) AS BIGINT) AS nbytes
      FROM valid GROUP BY conv_id)
    SELECT * FROM s WHERE nbytes <= 64000""",
)
def flagship(t):
    """Conversations assembled, normalised, validated and sized."""
    df = C.with_nbytes(C.filter_valid_conversations(W.normalized(W.raw(t))))
    return C.cap_size(df, 64_000).select(
        "conv_id", F.size("conversation").cast("bigint").alias("n_messages"), "nbytes"
    )


def doubled(t: Tables) -> DataFrame:
    """Every conversation once more under another id."""
    df = W.raw(t)
    return df.unionByName(df.withColumn("conv_id", F.col("conv_id") + 1_000_000))


_DOUBLED = W.sql_preprocess(
    W.VALID.replace(
        "FROM conversations)",
        "FROM (SELECT * FROM conversations UNION ALL "
        "SELECT conv_id + 1000000, turn, role, text FROM conversations))",
    )
)


@query(
    "preprocess",
    f"""WITH {_DOUBLED} SELECT conv_id, nbytes, CAST(row_number() OVER (
      PARTITION BY conv_id ORDER BY pos) - 1 AS BIGINT) AS pos, role, value FROM done""",
)
def preprocess_query(t):
    df = preprocess(doubled(t), W.OPTIONS)
    return df.select(
        "conv_id", "nbytes", F.posexplode("conversation").alias("pos", "m")
    ).select(
        "conv_id",
        "nbytes",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("m.from").alias("role"),
        F.col("m.value").alias("value"),
    )


@query(
    "stage_counts",
    f"""WITH {_DOUBLED}
    SELECT 'input' AS stage, count(DISTINCT conv_id) AS cnt FROM msgs
    UNION ALL SELECT 'valid', count(DISTINCT conv_id) FROM valid
    UNION ALL SELECT 'capped', count(DISTINCT conv_id) FROM capped
    UNION ALL SELECT 'preprocessed', count(DISTINCT conv_id) FROM done""",
)
def stages(t):
    df = doubled(t)
    return stage_counts(
        {
            "input": df,
            "valid": C.filter_valid_conversations(C.normalize(df, W.OPTIONS.system_prompt)),
            "capped": C.clean(df, W.OPTIONS),
            "preprocessed": preprocess(df, W.OPTIONS),
        }
    )


def options(balance: bool, store: str | None = None) -> CurateOptions:
    return CurateOptions(
        preprocess=W.OPTIONS,
        filtering=FilterOptions(
            dedup=True, thin=True, similarity_threshold=SIMILARITY, force_num_bins=BINS
        ),
        rewrite=RewriteOptions(enabled=True),
        output=OutputOptions(balance=balance, test_ratio=0.2),
        swaps=SWAPS,
        embedding_dimensions=DIMENSIONS,
        store_path=store,
        seed=W.SEED,
    )


BINS, DIMENSIONS, SIMILARITY = 4, 32, 0.9


def sql_curate() -> str:
    """The whole run as CTEs, from raw messages to ``curriculum`` and ``swapped``."""
    half = DIMENSIONS // 2
    space = W.SQL_SPACE
    bin_ = f"CASE WHEN high > low THEN (nbytes - low) * {BINS} // (high - low) ELSE {BINS} END"
    ratio = "CASE WHEN cnt > 2 THEN keep_ratio ELSE 1 END"
    sizes = f"""
recs AS (
  SELECT conv_id, nbytes FROM (
    SELECT conv_id, CAST(coalesce(sum({W.SQL_NBYTES}) FILTER (role <> 'system'), 0) AS BIGINT)
      AS nbytes FROM swapped GROUP BY conv_id)
  WHERE nbytes <= {W.MAX_NBYTES}),
lim AS (SELECT min(nbytes) AS low, max(nbytes) AS high, count(*) AS total FROM recs)"""
    return f"""{_DOUBLED},
kept0 AS (SELECT conv_id, any_value(nbytes) AS nbytes FROM done GROUP BY conv_id),
lim0 AS (SELECT min(nbytes) AS low, max(nbytes) AS high FROM kept0),
halves AS (
  SELECT conv_id, role, 'search_query: ' || string_agg(value, ' [SEP] ' ORDER BY pos) AS text
  FROM done WHERE role IN ('human', 'gpt') GROUP BY conv_id, role),
buckets AS (
  SELECT conv_id, ('0x' || substr(md5(w), 1, 8))::BIGINT % {half}
      + CASE role WHEN 'human' THEN 0 ELSE {half} END AS dim, count(*) AS n
  FROM (SELECT conv_id, role, unnest(list_filter(regexp_split_to_array(text, '{space}+'),
          lambda w: w <> '')) AS w FROM halves) GROUP BY ALL),
dense AS (
  SELECT k.conv_id, any_value(k.nbytes) AS nbytes,
         list(coalesce(b.n, 0)::DOUBLE ORDER BY d.dim) AS e
  FROM kept0 k JOIN (SELECT unnest(range({DIMENSIONS})) AS dim) d ON true
  LEFT JOIN buckets b ON b.conv_id = k.conv_id AND b.dim = d.dim GROUP BY k.conv_id),
placed0 AS (
  SELECT conv_id, nbytes, e, {bin_} AS bin,
         list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM dense, lim0),
near AS (
  SELECT DISTINCT b.conv_id FROM placed0 a JOIN placed0 b ON a.bin = b.bin
   AND (a.nbytes < b.nbytes OR (a.nbytes = b.nbytes AND a.conv_id < b.conv_id))
   AND list_dot_product(a.u, b.u) > {SIMILARITY}),
kept1 AS (SELECT conv_id, nbytes, e FROM dense WHERE conv_id NOT IN (SELECT conv_id FROM near)),
lim1 AS (SELECT min(nbytes) AS low, max(nbytes) AS high FROM kept1),
placed1 AS (SELECT conv_id, nbytes, e, {bin_} AS bin FROM kept1, lim1),
counts1 AS (
  SELECT x.bin, count(p.conv_id) AS cnt FROM (SELECT unnest(range({BINS} + 1)) AS bin) x
  LEFT JOIN placed1 p USING (bin) GROUP BY x.bin),
ratios AS (
  SELECT bin, cnt, CASE WHEN cnt > 0 THEN low::DOUBLE * greatest(1, {BINS} - bin_rank) / cnt END
    AS keep_ratio
  FROM (SELECT *, row_number() OVER (ORDER BY cnt DESC, bin DESC) - 1 AS bin_rank FROM counts1),
       lim1),
vecs AS (SELECT p.conv_id, p.bin, p.e, r.keep_ratio, r.cnt FROM placed1 p JOIN ratios r USING (bin)),
{sql_two_stage('kl', 'ner', ratio=ratio)},
final_msgs AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) - 1 AS pos, role, value
  FROM done WHERE conv_id IN (SELECT conv_id FROM stage2)),
asked AS (
  SELECT conv_id, max(CASE WHEN pos = 0 THEN
      CASE WHEN role = 'system' THEN value ELSE {W.quote(DEFAULT_CURRENT_PROMPT)} END END) AS current,
    coalesce(string_agg(CASE role WHEN 'human' THEN 'User Prompt' ELSE 'My Response' END
      || ': ' || value || chr(10), ' ' ORDER BY pos)
      FILTER (pos > 0 AND role IN ('human', 'gpt')), '') AS turns
  FROM final_msgs GROUP BY conv_id),
answered AS (
  SELECT conv_id, CASE WHEN length(p) % 5 <> 0 THEN 'I answer in ' || length(p) || ' ways.' END AS g
  FROM (SELECT conv_id, {sql_prompt('current')} AS p FROM asked)),
rewritten AS (
  SELECT m.conv_id, m.pos, m.role,
    CASE WHEN m.pos = 0 AND m.role = 'system' AND length(a.g) > 10 THEN a.g ELSE m.value END AS value
  FROM final_msgs m JOIN answered a USING (conv_id)),
swapped AS (SELECT conv_id, pos, role, {sql_swap('value')} AS value FROM rewritten),
{sql_balance(BINS, True, sizes)}, {sql_segments(BINS)}"""


@query(
    "curate",
    f"""WITH RECURSIVE {sql_curate()}, lines AS (
      SELECT conv_id, {SQL_LINE} AS line FROM swapped GROUP BY conv_id),
    split AS ({sql_split('segs', 'segment')})
    SELECT c.conv_id, c.nbytes, c.position, s.split, l.line
    FROM curriculum c JOIN split s USING (conv_id) JOIN lines l USING (conv_id)""",
)
def curate_query(t):
    done = curate(doubled(t), options(balance=True), make_generator=make_generator)
    return done.split.select(
        "conv_id", "nbytes", "position", "split", M.conversation_line(F.col("conversation")).alias("line")
    )


@query("curate_unbalanced")
def curate_unbalanced(t):
    done = curate(doubled(t), options(balance=False), make_generator=make_generator)
    return report(done)


@query(
    "curate_counts",
    f"""WITH {_DOUBLED}, final AS (
      SELECT conv_id, CAST(coalesce(sum({W.SQL_NBYTES}) FILTER (role <> 'system'), 0) AS BIGINT)
        AS nbytes FROM done GROUP BY conv_id)
    SELECT 'input' AS stage, count(DISTINCT conv_id) AS cnt FROM msgs
    UNION ALL SELECT 'preprocessed', count(DISTINCT conv_id) FROM done
    UNION ALL SELECT 'final', count(*) FROM final WHERE nbytes <= {W.MAX_NBYTES}""",
)
def curate_counts(t):
    """With near duplicates and thinning off."""
    plain = CurateOptions(preprocess=W.OPTIONS, seed=W.SEED)
    done = curate(doubled(t), plain)
    return t.spark.createDataFrame(list(done.counts.items()), "stage string, cnt bigint")
