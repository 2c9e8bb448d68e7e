"""Queries of this subpackage over the given tables, and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    filter_audit,
    html_text,
    jaccard_join,
    language_id,
    mixing,
    periodic_runs,
    pii,
    secrets,
    substring_dedup,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query(
    "op3_exact_dedup",
    r"""
    WITH n AS (
      SELECT doc_id, length(coalesce(text, '')) AS points,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
      FROM documents),
    g AS (
      SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size
      FROM n)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
    FROM g""",
)
def op3_exact_dedup(spark, sf_dir):
    done = exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query(
    "op5_mix_sources",
    r"""
    WITH s AS (
      SELECT doc_id, source,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
      FROM documents),
    t AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
    w AS (
      SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::DOUBLE
                AS weight, source_size * 3.0::DOUBLE AS cap
      FROM t),
    l AS (
      SELECT *,
        (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0.0)) /
        (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0.0)) AS level
      FROM w
      WINDOW o AS (ORDER BY cap / weight, encode(source) NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    m AS (SELECT max(CASE WHEN level * weight <= cap THEN level END) AS level FROM l),
    r AS (
      SELECT l.source, l.source_size,
             coalesce(least(l.cap, m.level * l.weight), l.cap) AS target
      FROM l, m),
    q AS (
      SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM r)
    SELECT s.doc_id, s.size, q.source_size, q.target,
           s.size * (floor(q.rate)::BIGINT
             + CASE WHEN ('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, '')), 1, 12))::BIGINT
                         / 281474976710656.0::DOUBLE < q.rate - floor(q.rate)
                    THEN 1 ELSE 0 END) AS taken
    FROM s JOIN q ON s.source IS NOT DISTINCT FROM q.source""",
)
def op5_mix_sources(spark, sf_dir):
    plan = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@_query("op6_decontaminate")
def op6_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), short_items=True
    )


@_query(
    "op7_chat_format",
    r"""
    WITH c AS (
      SELECT conv_id,
             list('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '')
                  || '<|im_end|>' || chr(10) ORDER BY turn, role, text) AS turns
      FROM conversations GROUP BY conv_id),
    d AS (SELECT min(conv_id) AS conv_id, turns FROM c GROUP BY turns),
    p AS (
      SELECT DISTINCT list_slice(turns, 1, k) AS turns
      FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM d))
    SELECT conv_id, len(turns)::BIGINT AS n_turns, array_to_string(turns, '') AS text
    FROM d WHERE turns NOT IN (SELECT turns FROM p)""",
)
def op7_chat_format(spark, sf_dir):
    turns = chat_format.maximal_conversations(_table(spark, sf_dir, "conversations"))
    return chat_format.render(turns)


@_query("op8_personal_data")
def op8_personal_data(spark, sf_dir):
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))

    def count(number: int):
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(number).alias(f"n_{kind}") for number, kind in enumerate(pii.KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(F.concat("base", "added")).alias("spans"),
    )


@_query("op1_language_id")
def op1_language_id(spark, sf_dir):
    return language_id.identify_languages(_table(spark, sf_dir, "documents"))


@_query("op9_html_text")
def op9_html_text(spark, sf_dir):
    text = html_text.extract_main_text(_table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.char_length("text").cast("long"))


@_query("op10_secrets")
def op10_secrets(spark, sf_dir):
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))

    def count(number: int):
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(number).alias(f"n_{kind}") for number, kind in enumerate(secrets.KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.base_text(F.col("base")), 256).alias("base_sha256"),
        secrets.all_text(F.col("base"), F.col("added")).alias("spans"),
    )


@_query(
    "op2_jaccard_join",
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
      FROM documents),
    s AS (
      SELECT doc_id, unnest(CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_distinct([array_to_string(words[i : i + 3], ' ') FOR i IN range(1, len(words) - 2)])
        END) AS sh
      FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    sets AS (SELECT doc_id, list(sh ORDER BY sh) AS st FROM s GROUP BY doc_id),
    reps AS (SELECT min(doc_id) AS rep, list(doc_id) AS members FROM sets GROUP BY st),
    inter AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
      FROM (SELECT * FROM s WHERE doc_id IN (SELECT rep FROM reps)) a
      JOIN (SELECT * FROM s WHERE doc_id IN (SELECT rep FROM reps)) b
        ON a.sh = b.sh AND a.doc_id < b.doc_id
      GROUP BY ALL),
    half AS (
      SELECT a, b FROM inter
      JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * i >= 85 * (na.n + nb.n - i)
      UNION ALL SELECT rep, unnest(members) FROM reps),
    link AS (SELECT a, b FROM half UNION SELECT b, a FROM half),
    reach AS (
      SELECT doc_id AS a, doc_id AS b FROM documents
      UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.c AS component_id
    FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
    JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id""",
)
def op2_jaccard_join(spark, sf_dir):
    options = jaccard_join.JaccardOptions(shingle=4, percent=85)
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), options=options)


@_query(
    "op4_substring_dedup",
    r"""
    WITH w AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    r AS (
      SELECT doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS h
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w)),
    f AS (SELECT h, min(doc_id) AS first FROM r GROUP BY h),
    hit AS (SELECT doc_id, i FROM r JOIN f USING (h) WHERE doc_id > first),
    gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hit, (SELECT unnest(range(0, 50)) AS k)),
    pos AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
    kept AS (
      SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
      FROM pos ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)""",
)
def op4_substring_dedup(spark, sf_dir):
    done = substring_dedup.repeated_spans(_table(spark, sf_dir, "documents"))
    return done.drop("removed")


@_query("op11_toxicity")
def op11_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


@_query(
    "op12_filter_audit",
    r"""
    WITH w AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
      FROM documents),
    m AS (SELECT text, min(doc_id) AS first FROM w GROUP BY text),
    marks AS (
      SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
      FROM labels GROUP BY doc_id),
    f AS (
      SELECT w.part, coalesce(marks.good, 0) AS good, coalesce(marks.toxic, 0) AS toxic,
        {'A': len(words) < 200,
         'B': 100 * len(list_distinct(words)) < 50 * len(words),
         'C': 100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 2 * length(w.text),
         'D': regexp_matches(w.text, '[#$%&*|]'),
         'E': coalesce(w.doc_id > m.first, false)} AS fails
      FROM w JOIN m ON m.text = w.text LEFT JOIN marks ON marks.doc_id = w.doc_id),
    cells AS (
      SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
      FROM f GROUP BY part, fails),
    bits AS (
      SELECT part, n, good, toxic, map(['A', 'B', 'C', 'D', 'E'],
        [fails['A'], fails['B'], fails['C'], fails['D'], fails['E']]) AS fails FROM cells),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
    orders AS (
      SELECT a.c || b.c || d.c || e.c || g.c AS filter_order
      FROM letters a, letters b, letters d, letters e, letters g
      WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
    steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
    x AS (
      SELECT part, filter_order, step, n, good, toxic,
             fails[filter_order[step]] AS here,
             len(list_filter(range(1, step), lambda i: fails[filter_order[i]])) > 0 AS earlier,
             len(list_filter(map_values(fails), lambda v: v)) AS n_fails
      FROM bits, steps),
    agg AS (
      SELECT part, filter_order, step, filter_order[step] AS letter,
        coalesce(sum(n) FILTER (NOT here AND NOT earlier), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (here AND NOT earlier), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (here AND earlier), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (here AND n_fails = 1), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (here AND NOT earlier), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (here AND NOT earlier), 0)::BIGINT AS toxic_lost
      FROM x GROUP BY ALL)
    SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails,
           good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
    FROM agg""",
)
def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit_filters(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def repeat_words(doc_id: str | None, text: str | None) -> str | None:
    """A tenth of the texts, chosen by the decimal id, made periodic from some word on; the
    others and those without id stay."""
    if doc_id is None or not text:
        return text
    g, rest = divmod(zlib.crc32(doc_id.encode()), 10)
    if rest:
        return text
    found = periodic_runs.split_words(text)
    n = len(found)
    if not n:
        return text
    begin = g % n
    period = 1 + (n - begin) // (3 + g % 8)
    found[begin:] = [found[begin + i % period] for i in range(n - begin)]
    return b" ".join(found).decode("utf-8", "surrogatepass")


@_query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    @F.pandas_udf("string")
    def repeated(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for ids, texts in batches:
            yield pd.Series(list(map(repeat_words, ids, texts)), dtype=object)

    docs = _table(spark, sf_dir, "documents")
    edited = repeated(F.col("doc_id").cast("string"), F.col("text"))
    found = periodic_runs.periodic_runs(
        docs.select("doc_id", edited.alias("text"))
    )
    longest = periodic_runs.longest_run(F.col("runs"))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.shorter")).alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(1000 * -F.col("longest.shorter") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(periodic_runs.run_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
