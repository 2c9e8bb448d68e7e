"""Vector functions, embedding scores, near duplicates and embedding operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.functions import vectors as V
from dialoom.operators import duplicates as D
from dialoom.operators import embed as E
from dialoom.operators import scores as S
from workload import common as W
from workload.registry import Tables, query

THRESHOLD = 0.3
RATIO = 0.4


def vectors(t: Tables) -> DataFrame:
    """All vectors, binned by label."""
    return t("embeddings").select(
        F.col("vec_id").alias("conv_id"),
        F.col("label").cast("bigint").alias("bin"),
        V.as_double(F.col("embedding")).alias("embedding"),
        (1000 + F.col("vec_id") * 37 % 101).alias("nbytes"),
    )


def with_copies(df: DataFrame) -> DataFrame:
    """Every vector once more under another id; one in seven of the copies is moved a
    little, so that it is near but not equal."""
    moved = F.when(
        F.col("conv_id") % 7 == 0,
        F.transform("embedding", lambda x, i: F.when(i < 3, x * 1.25).otherwise(x)),
    ).otherwise(F.col("embedding"))
    return df.unionByName(
        df.withColumn("embedding", moved).withColumn("conv_id", F.col("conv_id") + 1_000_000)
    )


VECS = """
vecs AS (
  SELECT vec_id AS conv_id, CAST(label AS BIGINT) AS bin, embedding::DOUBLE[] AS e,
         1000 + vec_id * 37 % 101 AS nbytes FROM embeddings)"""
COPIES = """
vecs AS (
  SELECT * FROM given UNION ALL
  SELECT conv_id + 1000000, bin,
    CASE WHEN conv_id % 7 = 0
         THEN list_transform(e, lambda x, i: CASE WHEN i <= 3 THEN x * 1.25 ELSE x END)
         ELSE e END, nbytes FROM given)"""
UNITS = """
units AS (
  SELECT conv_id, bin, nbytes, e,
    list_transform(e, lambda x: CASE WHEN n > 0 THEN x / n ELSE x END) AS u
  FROM (SELECT *, sqrt(list_dot_product(e, e)) AS n FROM vecs))"""
WITH_COPIES = VECS.replace("vecs AS", "given AS", 1) + "," + COPIES + "," + UNITS


def sql_scores(name: str, kind: str, rows: str, everyone: str, seed: int) -> str:
    """CTE ``name(conv_id, bin, e, score)`` over ``rows``; ``everyone`` is the bin."""
    unit = "list_transform({0}.e, lambda x: x / sqrt(list_dot_product({0}.e, {0}.e)))"
    if kind == "cosine":
        return f"""
{name} AS (
  SELECT a.conv_id, any_value(a.bin) AS bin, any_value(a.e) AS e,
    1 - avg(list_dot_product(a.u, b.u)) AS score
  FROM (SELECT *, {unit.format(rows)} AS u FROM {rows}) a
  JOIN (SELECT *, {unit.format(everyone)} AS u FROM {everyone}) b USING (bin) GROUP BY a.conv_id)"""
    if kind == "kl":
        half = "(len(e) // 2)"
        return f"""
{name}_h AS (SELECT conv_id, bin, e, e[1:{half}] AS q, e[{half} + 1:] AS a FROM {rows}),
{name}_r AS (
  SELECT bin, min(list_min(q)) AS ql, max(list_max(q)) AS qh,
         min(list_min(a)) AS al, max(list_max(a)) AS ah FROM {name}_h GROUP BY bin),
{name}_s AS (
  SELECT conv_id, bin, e,
    list_transform(q, lambda x: (x - ql) / greatest(qh - ql, 1)) AS q,
    list_transform(a, lambda x: (x - al) / greatest(ah - al, 1)) AS a
  FROM {name}_h JOIN {name}_r USING (bin)),
{name} AS (
  SELECT conv_id, bin, e, list_sum(list_transform(list_zip(
      list_transform(q, lambda x: x / list_sum(q)), list_transform(a, lambda x: x / list_sum(a))),
    lambda z: CASE WHEN z[1] > 0 AND z[2] > 0 THEN z[1] * ln(z[1] / z[2])
                   WHEN z[1] = 0 AND z[2] >= 0 THEN 0 ELSE 'inf'::DOUBLE END)) AS score
  FROM {name}_s)"""
    if kind == "ner":
        return f"""
{name} AS (
  SELECT conv_id, bin, e, CASE WHEN len(s) > 1
    THEN -list_sum(list_transform(s, lambda x: x / list_sum(s) * log2(x / list_sum(s))))
         / log2(len(s)) ELSE 0 END AS score
  FROM (SELECT *, list_filter(list_transform(e, lambda x: abs(x)), lambda x: x > 1e-12) AS s
        FROM {rows}))"""
    if kind == "entropy":
        return f"""
{name} AS (
  SELECT conv_id, bin, e, list_sum(list_transform(
      list_transform(e, lambda x: x / list_sum(e)),
      lambda p: CASE WHEN p > 0 THEN -p * ln(p) WHEN p = 0 THEN 0 ELSE '-inf'::DOUBLE END)) AS score
  FROM {rows})"""
    if kind == "variance_increase":
        return f"""
{name}_d AS (SELECT bin, unnest(e) AS x, generate_subscripts(e, 1) AS d FROM {rows}),
{name}_m AS (
  SELECT bin, list(m ORDER BY d) AS m
  FROM (SELECT bin, d, avg(x) AS m FROM {name}_d GROUP BY bin, d) GROUP BY bin),
{name} AS (SELECT conv_id, bin, e, list_distance(e, m) AS score
  FROM {rows} JOIN {name}_m USING (bin))"""
    return f"""
{name} AS (
  SELECT conv_id, bin, e,
    CAST(('0x' || substr(md5('{seed}:' || conv_id), 1, 13))::BIGINT AS DOUBLE) AS score
  FROM {rows})"""


def sql_top(name: str, scored: str, keep: str, quota: str) -> str:
    return f"""
{name} AS (
  SELECT s.conv_id, s.bin, s.e FROM {scored} s JOIN {quota} USING (bin)
  QUALIFY row_number() OVER (PARTITION BY s.bin ORDER BY s.score DESC, s.conv_id) <= {keep})"""


def sql_two_stage(first: str, second: str, rows: str = "vecs", ratio: str = "(0.125 + 0.25 * bin)::DOUBLE") -> str:
    """CTEs that end in ``stage2``; ``quota`` has the numbers to keep."""
    active = first != "none" or second != "none"
    k1 = "floor(n * sqrt(r))" if first in S.SCORES else "n"
    k2 = f"floor({k1} * sqrt(r))" if second in S.SCORES else k1
    thin = "r < 1" if active else "false"
    ctes = f"""
quota AS (
  SELECT bin, CASE WHEN {thin} THEN {k1} ELSE n END AS k1, CASE WHEN {thin} THEN {k2} ELSE n END AS k2
  FROM (SELECT bin, count(*) AS n, any_value({ratio}) AS r FROM {rows} GROUP BY bin))"""
    if first in S.SCORES:
        ctes += "," + sql_scores("score1", first, rows, rows, W.SEED)
        ctes += "," + sql_top("stage1", "score1", "k1", "quota")
    else:
        ctes += f", stage1 AS (SELECT conv_id, bin, e FROM {rows})"
    source = "stage1"
    if first == "cosine" and second != "cosine":
        ctes += """, stage1u AS (SELECT conv_id, bin,
          list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM stage1)"""
        source = "stage1u"
    if second in S.SCORES:
        ctes += "," + sql_scores("score2", second, source, rows, W.SEED + 1)
        ctes += "," + sql_top("stage2", "score2", "k2", "quota")
    else:
        ctes += ", stage2 AS (SELECT * FROM stage1)"
    return ctes


@query(
    "l2_normalize",
    f"""WITH {VECS},{UNITS} SELECT conv_id, unnest(range(len(u))) AS dim,
    unnest(list_transform(u, lambda x: round(x, 6))) AS x FROM units""",
)
def l2_normalize(t):
    unit = V.l2_normalize(F.col("embedding"))
    return vectors(t).select("conv_id", F.posexplode(unit).alias("dim", "x")).select(
        "conv_id", F.col("dim").cast("bigint").alias("dim"), F.round("x", 6).alias("x")
    )


@query(
    "cosine_similarity",
    """SELECT a.vec_id AS conv_id,
      round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def cosine(t):
    """Similarity of every vector to the next one."""
    v = vectors(t)
    after = v.select((F.col("conv_id") - 1).alias("conv_id"), F.col("embedding").alias("other"))
    return v.join(after, "conv_id").select(
        "conv_id",
        F.round(V.cosine_similarity(F.col("embedding"), F.col("other")), 6).alias("similarity"),
    )


@query(
    "mean_cosine_score",
    f"""WITH {VECS},{UNITS} SELECT a.conv_id, round(avg(list_dot_product(a.u, b.u)), 6)
      AS mean_cosine FROM units a JOIN units b USING (bin) GROUP BY a.conv_id""",
)
def mean_cosine(t):
    return S.mean_cosine_score(vectors(t)).select(
        "conv_id", F.round("mean_cosine", 6).alias("mean_cosine")
    )


@query(
    "minmax_global",
    f"""WITH {VECS}, h AS (
      SELECT conv_id, bin, e[1:len(e) // 2] AS q, e[len(e) // 2 + 1:] AS a FROM vecs),
    r AS (SELECT bin, min(list_min(q)) AS ql, max(list_max(q)) AS qh,
      min(list_min(a)) AS al, max(list_max(a)) AS ah FROM h GROUP BY bin)
    SELECT conv_id, unnest(range(len(q))) AS dim,
      unnest(list_transform(q, lambda x: round((x - ql) / greatest(qh - ql, 1), 6))) AS q,
      unnest(list_transform(a, lambda x: round((x - al) / greatest(ah - al, 1), 6))) AS a
    FROM h JOIN r USING (bin)""",
)
def minmax(t):
    z = F.arrays_zip("q_scaled", "a_scaled")
    return S.minmax_global(vectors(t)).select("conv_id", F.posexplode(z).alias("dim", "z")).select(
        "conv_id",
        F.col("dim").cast("bigint").alias("dim"),
        F.round("z.q_scaled", 6).alias("q"),
        F.round("z.a_scaled", 6).alias("a"),
    )


def _register_score(kind: str, name: str):
    @query(
        name,
        f"""WITH {VECS}, {sql_scores('scored', kind, 'vecs', 'vecs', W.SEED)},
        quota AS (SELECT bin, floor(count(*) * {RATIO}) AS k FROM vecs GROUP BY bin),
        {sql_top('top', 'scored', 'k', 'quota')} SELECT conv_id, bin FROM top""",
    )
    def kept(t):
        return S.select_top_ratio(S.with_score(vectors(t), kind, W.SEED), RATIO).select(
            "conv_id", "bin"
        )


_register_score("cosine", "score_cosine")
_register_score("kl", "score_kl")
_register_score("ner", "score_ner")
_register_score("entropy", "score_entropy")
_register_score("variance_increase", "score_variance")
_register_score("rand", "score_random")


def _register_values(kind: str, name: str, digits: int = 6):
    @query(
        name,
        f"""WITH {VECS}, {sql_scores('scored', kind, 'vecs', 'vecs', W.SEED)}
        SELECT conv_id, CASE WHEN isinf(score) THEN NULL ELSE round(score, {digits}) END AS score,
          CAST(isinf(score) AS INT) AS infinite FROM scored""",
    )
    def values(t):
        s = F.col("score")
        infinite = s.isin(float("inf"), float("-inf"))
        return S.with_score(vectors(t), kind, W.SEED).select(
            "conv_id",
            F.when(~infinite, F.round(s, digits)).alias("score"),
            infinite.cast("int").alias("infinite"),
        )


_register_values("kl", "score_kl_values")
_register_values("ner", "score_ner_values")
_register_values("variance_increase", "score_variance_values")


@query(
    "select_top_ratio",
    f"""WITH s AS (SELECT doc_id AS conv_id, CAST(length(lang) AS BIGINT) AS bin,
        CAST(n_chars % 50 AS DOUBLE) AS score FROM documents)
    SELECT conv_id, bin FROM s
    QUALIFY row_number() OVER (PARTITION BY bin ORDER BY score DESC, conv_id)
      <= floor(count(*) OVER (PARTITION BY bin) * {RATIO})""",
)
def top_ratio(t):
    """Many ties in one hot bin: all languages have codes of the same length."""
    scored = t("documents").select(
        F.col("doc_id").alias("conv_id"),
        F.length("lang").cast("bigint").alias("bin"),
        (F.col("n_chars") % 50).cast("double").alias("score"),
    )
    return S.select_top_ratio(scored, RATIO).select("conv_id", "bin")


def ratios(df: DataFrame) -> DataFrame:
    """Keep-ratios from an eighth up; above 1 nothing is dropped."""
    return df.groupBy("bin").agg(F.lit(1).alias("one")).select(
        "bin", (F.lit(0.125) + F.lit(0.25) * F.col("bin")).alias("keep_ratio")
    )


def _register_two_stage(name: str, first: str, second: str):
    @query(
        name,
        f"WITH {VECS}, {sql_two_stage(first, second)} SELECT conv_id, bin FROM stage2",
    )
    def kept(t):
        df = vectors(t)
        return S.two_stage_filter(df, ratios(df), first, second, W.SEED).select("conv_id", "bin")


_register_two_stage("two_stage_filter", "kl", "ner")
_register_two_stage("two_stage_filter_cosine_variance", "cosine", "variance_increase")
_register_two_stage("two_stage_filter_entropy_cosine", "entropy", "cosine")
_register_two_stage("two_stage_filter_none_rand", "none", "rand")
_register_two_stage("two_stage_filter_rand_kl", "rand", "kl")
_register_two_stage("two_stage_filter_unknown", "no_such_filter", "none")


@query(
    "similarity_filter",
    f"""WITH {VECS}, {sql_two_stage('cosine', 'kl', ratio='0.5')}
    SELECT bin, count(*) AS cnt, sum(conv_id)::BIGINT AS ids FROM stage2 GROUP BY bin""",
)
def similarity_filter(t):
    """The two-stage filter with one ratio for all bins."""
    df = vectors(t)
    same = df.select("bin").distinct().withColumn("keep_ratio", F.lit(0.5))
    kept = S.two_stage_filter(df, same, "cosine", "kl", W.SEED)
    return kept.groupBy("bin").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("conv_id").alias("ids")
    )


_PAIRS = f"""WITH {WITH_COPIES}, pairs AS (
  SELECT b.conv_id, a.conv_id AS partner_id, a.nbytes AS partner_nbytes
  FROM units a JOIN units b ON a.bin = b.bin
   AND (a.nbytes < b.nbytes OR (a.nbytes = b.nbytes AND a.conv_id < b.conv_id))
   AND list_dot_product(a.u, b.u) > {THRESHOLD})"""


def _register_duplicates(suffix: str, tile_rows: int):
    @query(
        "duplicate_pairs" + suffix,
        f"""{_PAIRS} SELECT conv_id, partner_id FROM pairs
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY partner_nbytes, partner_id) = 1""",
    )
    def pairs(t):
        return D.duplicate_pairs(with_copies(vectors(t)), THRESHOLD, tile_rows)

    @query(
        "near_duplicates" + suffix,
        f"""{_PAIRS} SELECT conv_id, bin FROM units
        WHERE conv_id NOT IN (SELECT conv_id FROM pairs)""",
    )
    def survivors(t):
        return D.near_duplicates(with_copies(vectors(t)), THRESHOLD, tile_rows).select(
            "conv_id", "bin"
        )


# the greedy walk through each bin in order: a row stays if none that stays is near
@query(
    "near_duplicates_independent",
    f"""WITH RECURSIVE {WITH_COPIES},
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY bin ORDER BY nbytes, conv_id) AS place FROM units),
    near AS (
      SELECT b.bin, b.place, any_value(b.conv_id) AS conv_id,
        list(a.conv_id) FILTER (a.conv_id IS NOT NULL) AS earlier
      FROM placed b LEFT JOIN placed a ON a.bin = b.bin AND a.place < b.place
        AND list_dot_product(a.u, b.u) > {THRESHOLD}
      GROUP BY b.bin, b.place),
    walk AS (
      SELECT DISTINCT bin, 0::BIGINT AS place, []::BIGINT[] AS kept FROM units
      UNION ALL
      SELECT w.bin, n.place, CASE WHEN list_has_any(coalesce(n.earlier, []), w.kept)
        THEN w.kept ELSE list_append(w.kept, n.conv_id) END
      FROM walk w JOIN near n ON n.bin = w.bin AND n.place = w.place + 1)
    SELECT bin, unnest(kept) AS conv_id FROM walk
    QUALIFY row_number() OVER (PARTITION BY bin ORDER BY place DESC) = 1""",
)
def independent(t):
    """Survivors of which no two are near, and that every dropped row is near to."""
    return D.near_duplicates(
        with_copies(vectors(t)), THRESHOLD, survivors="independent"
    ).select("conv_id", "bin")


_register_duplicates("", D.DEFAULT_TILE_ROWS)
_register_duplicates("_tiled", 32)


@query(
    "drop_exact_duplicates",
    """SELECT doc_id AS conv_id, n_chars AS nbytes FROM documents
    QUALIFY row_number() OVER (PARTITION BY lang, text ORDER BY n_chars, doc_id) = 1""",
)
def exact(t):
    """Documents as one-answer conversations; their texts have natural copies."""
    from dialoom.functions.messages import message

    df = t("documents").select(
        F.col("doc_id").alias("conv_id"),
        F.col("n_chars").alias("nbytes"),
        "source",
        F.array(
            message(F.lit("human"), F.col("lang")), message(F.lit("gpt"), F.col("text"))
        ).alias("conversation"),
    )
    return D.drop_exact_duplicates(df).select("conv_id", "nbytes")


DIMENSIONS = 32
_EMBED = f"""{W.SQL_MSGS}, texts AS (
  SELECT conv_id, role, 'search_query: ' || string_agg(value, ' [SEP] ' ORDER BY pos) AS text
  FROM msgs WHERE role IN ('human', 'gpt') GROUP BY conv_id, role),
halves AS (
  SELECT c.conv_id, h.role, coalesce(t.text, 'search_query: ') AS text
  FROM (SELECT DISTINCT conv_id FROM msgs) c
  JOIN (SELECT unnest(['human', 'gpt']) AS role) h ON true
  LEFT JOIN texts t ON t.conv_id = c.conv_id AND t.role = h.role),
buckets AS (
  SELECT conv_id, role, ('0x' || substr(md5(w), 1, 8))::BIGINT % {DIMENSIONS // 2} AS b
  FROM (SELECT conv_id, role, unnest(list_filter(regexp_split_to_array(text, '{W.SQL_SPACE}+'),
          lambda w: w <> '')) AS w FROM halves)),
embedded AS (
  SELECT conv_id, CASE role WHEN 'human' THEN b ELSE b + {DIMENSIONS // 2} END AS dim,
         CAST(count(*) AS DOUBLE) AS x
  FROM buckets GROUP BY ALL)"""


@query("embed_qa_pairs", f"WITH {_EMBED} SELECT conv_id, dim, x FROM embedded")
def embed(t):
    df = E.embed_hashed(W.with_roles(W.raw(t)), DIMENSIONS)
    return df.select("conv_id", F.posexplode("embedding").alias("dim", "x")).where(
        "x > 0"
    ).select("conv_id", F.col("dim").cast("bigint").alias("dim"), "x")


@query(
    "embed_with_model",
    f"""WITH {_EMBED} SELECT conv_id,
      CAST(length(max(text) FILTER (role = 'human')) AS DOUBLE) AS q,
      CAST(length(max(text) FILTER (role = 'gpt')) AS DOUBLE) AS a FROM (
        SELECT conv_id, role, array_to_string(list_filter(regexp_split_to_array(
          text, '{W.SQL_SPACE}+'), lambda w: w <> '')[1:8192], ' ') AS text FROM halves)
    GROUP BY conv_id""",
)
def embed_model(t):
    """A stand-in model, one number per text, through the batched Arrow path."""

    def make():
        return lambda texts: [[float(len(x))] for x in texts]

    df = E.embed_with(W.with_roles(W.raw(t)), make)
    return df.select(
        "conv_id", F.col("embedding")[0].alias("q"), F.col("embedding")[1].alias("a")
    )


@query(
    "concat_halves",
    """SELECT a.vec_id AS conv_id, CAST(len(a.embedding) + len(b.embedding) AS BIGINT) AS n,
      round(list_sum(list_concat(a.embedding, b.embedding)::DOUBLE[]), 6) AS total
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def concat_halves(t):
    v = vectors(t)
    after = v.select((F.col("conv_id") - 1).alias("conv_id"), F.col("embedding").alias("other"))
    both = V.concat_halves(F.col("embedding"), F.col("other"))
    return v.join(after, "conv_id").select(
        "conv_id",
        F.size(both).cast("bigint").alias("n"),
        F.round(V.total(both), 6).alias("total"),
    )


@query(
    "mean_pool",
    """WITH parts AS (
      SELECT label, CAST(vec_id % 3 > 0 AS INT) AS mask, unnest(embedding::DOUBLE[]) AS x,
             generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
    SELECT CAST(label AS BIGINT) AS conv_id, CAST(dim AS BIGINT) AS dim,
      round(sum(x * mask) / greatest(sum(mask), 1e-9), 6) AS x
    FROM parts GROUP BY label, dim""",
)
def mean_pool(t):
    """Vectors of a label as the tokens of one text."""
    tokens = vectors(t).select(
        F.col("bin").alias("conv_id"),
        (F.col("conv_id") % 3 > 0).cast("int").alias("mask"),
        F.col("embedding").alias("vector"),
    )
    return E.mean_pool(tokens).select("conv_id", F.posexplode("pooled").alias("dim", "x")).select(
        "conv_id", F.col("dim").cast("bigint").alias("dim"), F.round("x", 6).alias("x")
    )


_PRE = f"""WITH {_EMBED}, dense AS (
  SELECT c.conv_id, d.dim, coalesce(e.x, 0) AS x
  FROM (SELECT DISTINCT conv_id FROM msgs) c
  JOIN (SELECT unnest(range({DIMENSIONS})) AS dim) d ON true
  LEFT JOIN embedded e ON e.conv_id = c.conv_id AND e.dim = d.dim)
SELECT 'partly' AS input, conv_id, round(sum(x), 4) AS total, CAST(count(*) AS BIGINT) AS n
FROM dense GROUP BY conv_id
UNION ALL
SELECT 'complete', vec_id, round(list_sum(embedding::DOUBLE[]), 4), CAST(len(embedding) AS BIGINT)
FROM embeddings WHERE vec_id IN (SELECT conv_id FROM conversations)"""


@query("precomputed_embeddings", _PRE)
def precomputed(t):
    """Vectors for some records: all are computed.  Vectors for all: they are used."""
    records = W.with_roles(W.raw(t))
    given = t("embeddings").select(
        F.col("vec_id").alias("conv_id"), F.col("embedding").alias("qa_pair_embeddings")
    )
    first_half = F.col("conv_id") % 2 == 0

    def embed(df):
        return E.embed_hashed(df, DIMENSIONS)

    partly = E.with_embeddings(records.join(given.where(first_half), "conv_id", "left"), embed)
    complete = E.with_embeddings(records.join(given, "conv_id"), embed)

    def report(df, name):
        return df.select(
            F.lit(name).alias("input"),
            "conv_id",
            F.round(V.total(F.col("embedding")), 4).alias("total"),
            F.size("embedding").cast("bigint").alias("n"),
        )

    return report(partly, "partly").unionByName(report(complete, "complete"))


