"""Size order, bins, balancing and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialoom.operators import balance as L
from dialoom.operators import bins as B
from dialoom.operators import split as S
from dialoom.operators.clean import cap_size
from dialoom.operators.ranking import rank_by_range
from workload import common as W
from workload.registry import query
from workload.vector_queries import sql_two_stage

NBINS = 6

SIZES = f"""{W.SQL_MSGS},
recs AS (
  SELECT conv_id, CAST(coalesce(sum({W.SQL_NBYTES}) FILTER (role <> 'system'), 0) AS BIGINT)
    AS nbytes FROM msgs GROUP BY conv_id),
lim AS (SELECT min(nbytes) AS low, max(nbytes) AS high, count(*) AS total FROM recs)"""


def sql_bin(n: str) -> str:
    return f"CASE WHEN high > low THEN ((nbytes - low) * {n}) // (high - low) ELSE {n} END"


def sql_counts(n: int) -> str:
    return f"""
binned AS (SELECT conv_id, nbytes, {sql_bin(str(n))} AS bin FROM recs, lim),
counts AS (
  SELECT e.bin, count(b.conv_id) AS cnt FROM (SELECT unnest(range({n} + 1)) AS bin) e
  LEFT JOIN binned b USING (bin) GROUP BY e.bin),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY cnt DESC, bin DESC) - 1 AS bin_rank FROM counts)"""


@query(
    "sort_by_size",
    f"""WITH {SIZES} SELECT conv_id, nbytes,
      row_number() OVER (ORDER BY nbytes, conv_id) - 1 AS rank FROM recs""",
)
def sort_by_size(t):
    return rank_by_range(W.sized(t), ["nbytes", "conv_id"])


@query("cap_size", f"WITH {SIZES} SELECT * FROM recs WHERE nbytes <= 2000")
def cap(t):
    return cap_size(W.sized(t), 2000)


def _binned(t, n=NBINS):
    df = W.sized(t)
    low, high, _ = B.size_range(df)
    return B.assign_bins(df, B.Binning(n, low, high))


@query("assign_bins", f"WITH {SIZES},{sql_counts(NBINS)} SELECT conv_id, nbytes, bin FROM binned")
def assign_bins(t):
    return _binned(t)


@query("bin_counts", f"WITH {SIZES},{sql_counts(40)} SELECT bin, cnt FROM counts")
def bin_counts(t):
    return B.bin_counts(_binned(t, 40), 40)


@query("bin_ranking", f"WITH {SIZES},{sql_counts(NBINS)} SELECT bin, cnt, bin_rank FROM ranked")
def bin_ranking(t):
    return B.bin_ranking(B.bin_counts(_binned(t), NBINS))


def sql_targets(n: int, boost: float, low: str = "low") -> str:
    return f"""
targets AS (
  SELECT bin, cnt, bin_rank, least_count * greatest(1, {n} - bin_rank) AS target,
    CASE WHEN cnt > 0 THEN least_count * greatest(1, {n} - bin_rank) / cnt END AS keep_ratio
  FROM ranked, (SELECT greatest(sum(cnt) / count(*) FILTER (cnt > 0) / {n} * (1.0::DOUBLE - {boost}),
                                CAST(low AS DOUBLE)) AS least_count
                FROM counts, (SELECT {low} AS low FROM lim)
                GROUP BY low))"""


@query(
    "bin_target_size",
    f"""WITH {SIZES},{sql_counts(NBINS)},{sql_targets(NBINS, 0.5, '1')}
    SELECT bin, cnt, bin_rank, round(target, 6) AS target, round(keep_ratio, 6) AS keep_ratio
    FROM targets""",
)
def bin_target_size(t):
    """With a smallest size of 1, so that the average count decides."""
    return B.bin_targets(B.bin_counts(_binned(t), NBINS), NBINS, 1, 0.5).select(
        "bin",
        "cnt",
        "bin_rank",
        F.round("target", 6).alias("target"),
        F.round("keep_ratio", 6).alias("keep_ratio"),
    )


SEARCH = f"""{SIZES},
hist AS (SELECT nbytes, count(*) AS cnt FROM recs GROUP BY nbytes),
cand AS (SELECT unnest(range(2, high + 1)) AS nbins, low, high, total FROM lim),
fills AS (
  SELECT nbins, any_value(low) AS low, any_value(total) AS total, {sql_bin('nbins')} AS bin,
         sum(cnt) AS c
  FROM cand, hist GROUP BY nbins, {sql_bin('nbins')}),
judged AS (
  SELECT nbins, any_value(total)::DOUBLE / count(*) AS average,
    greatest(any_value(total)::DOUBLE / count(*) / nbins, any_value(low)) AS m,
    sqrt(sum(c::DOUBLE * c) / (nbins + 1) - pow(any_value(total)::DOUBLE / (nbins + 1), 2)) AS dev
  FROM fills GROUP BY nbins),
stop AS (SELECT min(nbins) AS last FROM judged WHERE nbins > average),
best AS (
  SELECT arg_min(nbins, (m / dev, nbins)) AS nbins FROM judged, stop
  WHERE nbins <= coalesce(last, nbins) AND dev > 1e-5)"""


@query(
    "optimal_bins",
    f"""WITH {SEARCH} SELECT nbins, low AS low_nbytes, high AS high_nbytes FROM best, lim""",
)
def optimal_bins(t):
    found = B.optimal_bins(W.sized(t))
    return t.spark.createDataFrame(
        [(found.nbins, found.low, found.high)],
        "nbins bigint, low_nbytes bigint, high_nbytes bigint",
    )


@query(
    "optimal_bins_candidates",
    f"""WITH {SEARCH} SELECT nbins, round(average, 6) AS average, round(dev, 6) AS deviation,
      round(m / dev, 6) AS score, CAST(nbins > average AS INT) AS stop
    FROM judged, stop WHERE nbins <= coalesce(last, nbins)""",
)
def candidates(t):
    df = W.sized(t)
    low, high, _ = B.size_range(df)
    judged = B.bin_candidates(B.size_counts(df), low, high, 2, high)
    last = judged.where("stop").agg(F.min("nbins")).first()[0]
    return judged.where(F.col("nbins") <= (last or high)).select(
        "nbins",
        F.round("average", 6).alias("average"),
        F.round("deviation", 6).alias("deviation"),
        F.round("score", 6).alias("score"),
        F.col("stop").cast("int").alias("stop"),
    )


@query(
    "size_histogram",
    f"""WITH {SIZES}, h AS (
      SELECT least((nbytes - low) * 12 // (high - low), 11) AS bin, count(*) AS cnt
      FROM recs, lim GROUP BY 1), e AS (
      SELECT bin, low + bin * ((high - low)::DOUBLE / 12) AS a,
             low + (bin + 1) * ((high - low)::DOUBLE / 12) AS b
      FROM lim, (SELECT unnest(range(12)) AS bin)), c AS (
      SELECT e.bin, a, b, coalesce(cnt, 0) AS cnt FROM e LEFT JOIN h USING (bin))
    SELECT bin, CAST(round_even(a, 0) AS BIGINT) || '-' || CAST(round_even(b, 0) AS BIGINT)
        AS size_range, cnt,
      repeat('*', CAST(floor(cnt * (100.0::DOUBLE / max(cnt) OVER ())) AS INT)) AS bar FROM c""",
)
def size_histogram(t):
    return B.size_histogram(W.sized(t), 12)


_EMBEDDED = f"""{SIZES},{sql_counts(NBINS)},{sql_targets(NBINS, 1.0, '1')},
vecs AS (
  SELECT r.conv_id, r.bin, r.nbytes, e.embedding::DOUBLE[] AS e, t.keep_ratio, t.cnt
  FROM binned r JOIN embeddings e ON e.vec_id = r.conv_id JOIN targets t ON t.bin = r.bin),
{sql_two_stage('kl', 'ner', ratio='CASE WHEN cnt > 2 THEN keep_ratio ELSE 1 END')}"""


@query("histogram_filter", f"WITH {_EMBEDDED} SELECT conv_id, bin FROM stage2")
def histogram_filter(t):
    """Conversations with the vectors of the same id.  A smallest size of 1 keeps
    the targets below the counts."""
    vectors = t("embeddings").select(
        F.col("vec_id").alias("conv_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    df = _binned(t).join(vectors, "conv_id")
    targets = B.bin_targets(B.bin_counts(df, NBINS), NBINS, 1, 1.0)
    return B.filter_by_targets(df, targets, "kl", "ner", W.SEED).select("conv_id", "bin")


_SEEDED = f"md5('{W.SEED}:' || conv_id)"


def sql_balance(n: int, include_max: bool, sizes: str = SIZES) -> str:
    """A recursive walk over the bins, from small to large sizes."""
    clamp = f"least({sql_bin(str(n))}, {n} - 1)" if include_max else sql_bin(str(n))
    return f"""{sizes},
tgt AS (SELECT CAST(ceil(total / {n}) AS BIGINT) AS t FROM lim),
binned AS (SELECT conv_id, nbytes, bin FROM (
  SELECT conv_id, nbytes, {clamp} AS bin FROM recs, lim) WHERE bin < {n}),
counts AS (
  SELECT e.bin, count(b.conv_id) AS cnt FROM (SELECT unnest(range({n})) AS bin) e
  LEFT JOIN binned b USING (bin) GROUP BY e.bin),
walk AS (
  SELECT CAST(-1 AS BIGINT) AS bin, CAST(0 AS BIGINT) AS pool, CAST(0 AS BIGINT) AS taken,
         CAST(0 AS BIGINT) AS kept
  UNION ALL
  SELECT c.bin, w.pool + greatest(c.cnt - t, 0) - least(greatest(t - c.cnt, 0), w.pool),
         least(greatest(t - c.cnt, 0), w.pool), least(c.cnt, t)
  FROM walk w JOIN counts c ON c.bin = w.bin + 1, tgt),
places AS (
  SELECT bin, taken, kept,
    coalesce(sum(kept + taken) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS start
  FROM walk WHERE bin >= 0),
placed_recs AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.bin ORDER BY
      CASE WHEN c.cnt > t THEN 0 ELSE b.nbytes END, {_SEEDED}, b.conv_id) AS rank
  FROM binned b JOIN counts c USING (bin), tgt),
excess AS (
  SELECT n.*, row_number() OVER (ORDER BY n.bin, n.rank) AS number
  FROM placed_recs n JOIN places p USING (bin) WHERE n.rank > p.kept),
slots AS (
  SELECT bin AS target_bin, start + kept + i AS position,
         row_number() OVER (ORDER BY bin, i) AS number
  FROM (SELECT *, unnest(range(taken)) AS i FROM places)),
balanced AS (
  SELECT n.conv_id, n.nbytes, n.bin, n.bin AS target_bin,
         CAST(p.start + n.rank - 1 AS BIGINT) AS position
  FROM placed_recs n JOIN places p USING (bin) WHERE n.rank <= p.kept
  UNION ALL
  SELECT conv_id, nbytes, bin, target_bin, CAST(position AS BIGINT)
  FROM excess JOIN slots USING (number)),
chunked AS (SELECT b.*, position // t AS chunk, t FROM balanced b, tgt),
curriculum AS (
  SELECT conv_id, nbytes, chunk, chunk * t + row_number() OVER (
    PARTITION BY chunk ORDER BY md5('{W.SEED}c:' || conv_id), conv_id) - 1 AS position
  FROM chunked)"""


def _balanced(t, include_max=True):
    return L.balance_bins(W.sized(t), NBINS, W.SEED, include_max)


@query(
    "balance_bins",
    f"WITH RECURSIVE {sql_balance(NBINS, True)} SELECT * FROM balanced",
)
def balance(t):
    return _balanced(t)[0]


@query(
    "balance_bins_without_max",
    f"WITH RECURSIVE {sql_balance(NBINS, False)} SELECT * FROM balanced",
)
def balance_strict(t):
    return _balanced(t, include_max=False)[0]


def _curriculum(t):
    return L.curriculum_shuffle(*_balanced(t), W.SEED)


@query(
    "curriculum_shuffle",
    f"""WITH RECURSIVE {sql_balance(NBINS, True)}
    SELECT conv_id, nbytes, chunk, position FROM curriculum""",
)
def curriculum(t):
    return _curriculum(t).select("conv_id", "nbytes", "chunk", "position")


@query(
    "chunk_stats",
    f"""WITH RECURSIVE {sql_balance(NBINS, True)} SELECT chunk, count(*) AS cnt,
      min(nbytes) AS min_nbytes, max(nbytes) AS max_nbytes FROM curriculum GROUP BY chunk""",
)
def chunk_stats(t):
    return L.chunk_stats(_curriculum(t))


def sql_split(rows: str, stratum: str) -> str:
    return f"""SELECT conv_id, {stratum}, CASE WHEN row_number() OVER (PARTITION BY {stratum}
        ORDER BY md5('{W.SEED}s:' || conv_id), conv_id)
      <= floor(count(*) OVER (PARTITION BY {stratum}) * 0.2::DOUBLE)
      THEN 'test' ELSE 'train' END AS split FROM {rows}"""


def sql_segments(n: int) -> str:
    return f"""segs AS (
  SELECT conv_id, least(position // (n // {n}), {n} - 1) AS segment
  FROM curriculum, (SELECT count(*) AS n FROM curriculum))"""


@query(
    "split_by_segment",
    f"""WITH RECURSIVE {sql_balance(NBINS, True)}, {sql_segments(NBINS)}
    {sql_split('segs', 'segment')}""",
)
def split_by_segment(t):
    return S.split_by_segment(_curriculum(t), NBINS, 0.2, W.SEED).select(
        "conv_id", "segment", "split"
    )


def sql_size_bins(include_max: bool) -> str:
    number = f"nbytes * {NBINS} // high"
    if include_max:
        number = f"least({number}, {NBINS} - 1)"
    return f"""{SIZES}, bins AS (
      SELECT conv_id, {number} AS size_bin FROM recs, lim WHERE {number} < {NBINS})"""


def _register_size_split(name: str, include_max: bool):
    @query(name, f"WITH {sql_size_bins(include_max)} {sql_split('bins', 'size_bin')}")
    def split(t):
        return S.split_by_size_bin(W.sized(t), NBINS, 0.2, W.SEED, include_max).select(
            "conv_id", "size_bin", "split"
        )


_register_size_split("split_by_size_bin", True)
_register_size_split("split_by_size_bin_without_max", False)


@query(
    "split_counts",
    f"""WITH {sql_size_bins(False)}, s AS ({sql_split('bins', 'size_bin')})
    SELECT 'total' AS split, count(*) AS cnt FROM recs
    UNION ALL SELECT split, count(*) FROM s GROUP BY split""",
)
def split_counts(t):
    df = W.sized(t)
    return S.split_counts(df, S.split_by_size_bin(df, NBINS, 0.2, W.SEED, False))
