"""Scores and duplicates against numpy and brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialoom.functions import vectors as V
from dialoom.operators import cosine as C
from dialoom.operators import duplicates as D
from dialoom.operators import embed as E
from dialoom.operators import scores as S
from dialoom.session import stage_table

SCHEMA = "conv_id bigint, nbytes bigint, bin bigint, embedding array<double>"


def one(spark, vector, fn):
    df = spark.createDataFrame([(vector,)], "v array<double>")
    return df.select(fn(F.col("v")).alias("x")).first().x


def test_normalize(spark):
    assert one(spark, [3.0, 4.0], V.l2_normalize) == [0.6, 0.8]
    assert one(spark, [0.0, 0.0], V.l2_normalize) == [0.0, 0.0]
    assert one(spark, None, V.l2_normalize) is None


def test_effective_rank(spark):
    assert one(spark, [0.0, 5.0, 0.0], V.normalized_effective_rank) == 0.0
    assert one(spark, [0.0, 0.0], V.normalized_effective_rank) == 0.0
    assert one(spark, [-2.0, 2.0, 2.0], V.normalized_effective_rank) == pytest.approx(1.0)


def test_entropy(spark):
    assert one(spark, [1.0, 1.0], V.entropy) == pytest.approx(math.log(2))
    assert one(spark, [2.0, -1.0], V.entropy) == -math.inf
    assert one(spark, [-1.0, -1.0], V.entropy) == pytest.approx(math.log(2))
    assert math.isnan(one(spark, [0.0, 0.0], V.entropy))
    assert one(spark, [0.0, 3.0], V.entropy) == 0.0


def test_kl(spark):
    def kl(p, q):
        df = spark.createDataFrame([(p, q)], "p array<double>, q array<double>")
        return df.select(V.kl_divergence(F.col("p"), F.col("q")).alias("x")).first().x

    assert kl([1.0, 1.0], [0.0, 1.0]) == math.inf
    assert kl([0.0, 1.0], [1.0, 1.0]) == pytest.approx(math.log(2))
    assert kl([0.0, 1.0], [0.0, 1.0]) == 0.0
    assert math.isnan(kl([0.0, 0.0], [1.0, 1.0]))


def test_halves(spark):
    assert one(spark, [1.0, 2.0, 3.0, 4.0], V.question_half) == [1.0, 2.0]
    assert one(spark, [1.0, 2.0, 3.0, 4.0], V.answer_half) == [3.0, 4.0]


def test_select_top_order(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, 1.0), (2, 0, nan), (3, 0, inf), (4, 0, 1.0), (5, 0, -inf), (6, 1, 0.0)]
    df = spark.createDataFrame(rows, "conv_id bigint, bin bigint, score double")

    def kept(ratio):
        return sorted(r.conv_id for r in S.select_top_ratio(df, ratio).collect())

    assert kept(0.1) == []
    assert kept(0.4) == [2, 3]
    assert kept(0.6) == [1, 2, 3]
    assert kept(1.0) == [1, 2, 3, 4, 5, 6]


def rows_of(vectors, bins=None, sizes=None):
    n = len(vectors)
    bins = bins or [0] * n
    sizes = sizes or list(range(n))
    return [(i, s, b, [float(x) for x in v]) for i, (v, b, s) in enumerate(zip(vectors, bins, sizes))]


def brute_force(rows, threshold):
    """conv_id -> earliest partner."""
    unit = {}
    for i, _, _, v in rows:
        n = math.sqrt(sum(x * x for x in v))
        unit[i] = np.array(v) / n if n else np.array(v)
    partners = {}
    for i, s, b, _ in rows:
        earlier = [
            (s2, j)
            for j, s2, b2, _ in rows
            if b2 == b and (s2, j) < (s, i) and float(unit[i] @ unit[j]) > threshold
        ]
        if earlier:
            partners[i] = min(earlier)[1]
    return partners


@pytest.mark.parametrize(
    ("vectors", "bins", "kept"),
    [
        ([[1, 0], [1, 0.1]], None, [0]),
        ([[1, 0], [1, 0.1], [1, 0.05]], None, [0]),
        ([[1, 0], [1, 1], [0, 1]], None, [0]),  # a ~ b ~ c, a and c apart
        ([[1, 0], [1, 0.1]], [0, 1], [0, 1]),
        ([[0, 0], [0, 0], [1, 0]], None, [0, 1, 2]),
        ([[1, 0], [3, 4]], None, [0]),
    ],
)
def test_near_duplicates(spark, vectors, bins, kept):
    df = spark.createDataFrame(rows_of(vectors, bins), SCHEMA)
    got = sorted(r.conv_id for r in D.near_duplicates(df, 0.599).collect())
    assert got == kept


def test_similarity_equal_to_threshold_is_no_duplicate(spark):
    df = spark.createDataFrame(rows_of([[1, 0], [3, 4]]), SCHEMA)
    assert D.near_duplicates(df, 0.6).count() == 2


@pytest.mark.parametrize(("threshold", "tile_rows"), [(-0.2, 40), (0.5, 10), (0.9, 25), (0.95, 5000)])
def test_pairs_against_brute_force(spark, threshold, tile_rows):
    """Clusters, copies, a hot bin, and many small tiles."""
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(6, 8))
    vectors = [centers[i % 6] + 0.25 * rng.normal(size=8) for i in range(120)]
    vectors += [vectors[3]] * 60 + [np.zeros(8)] * 2
    bins = [0 if i % 3 else i % 4 for i in range(len(vectors))]
    sizes = [int(x) for x in rng.integers(0, 30, size=len(vectors))]
    rows = rows_of(vectors, bins, sizes)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    wanted = brute_force(rows, threshold)
    pairs = {r.conv_id: r.partner_id for r in D.duplicate_pairs(df, threshold, tile_rows).collect()}
    kept = {r.conv_id for r in D.near_duplicates(df, threshold, tile_rows).collect()}
    if threshold < 0:
        # a zero vector meets everything; only those with a direction are compared here
        zero = {i for i, _, _, v in rows if not any(v)}
        assert kept - zero == {i for i, *_ in rows} - set(wanted) - zero
        return
    assert pairs == wanted
    assert kept == {i for i, *_ in rows} - set(wanted)


def test_blocks_of_clusters_meet_few_others(spark):
    """Wide vectors in tight clusters: each vector is written once and sent to few tasks."""
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 768))
    vectors = [centers[i % 40] + 0.02 * rng.normal(size=768) for i in range(1600)]
    df = spark.createDataFrame(rows_of(vectors), SCHEMA)
    unit = D._distinct_vectors(df).withColumn("late", F.lit(True))
    blocks = C._blocks(unit, 40, C.choose_heads(unit, 0.95))
    pairs = C._block_pairs(blocks, 0.95).collect()
    n = blocks.count()
    assert n == 40 and sum(len(r.ids) for r in blocks.select("ids").collect()) == 1600
    copies = sum(2 if p.a != p.b else 1 for p in pairs) / n
    assert copies < 8


def wide(n, dimensions, seed=17):
    """Directions without structure; one in twenty is a slightly moved earlier one."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, dimensions))
    for i in range(19, n, 20):
        vectors[i] = vectors[rng.integers(0, i)] + 0.2 * rng.normal(size=dimensions)
    return list(vectors)


def test_wide_vectors_without_structure_test_few_pairs(spark):
    rows = rows_of(wide(1200, 256))
    df = spark.createDataFrame(rows, SCHEMA)
    vectors = stage_table(D._distinct_vectors(df).withColumn("late", F.lit(True)), "vectors")
    found, tested = C.earliest_partners(vectors, 0.8, 100)
    wanted = brute_force(rows, 0.8)
    assert len(wanted) > 50
    assert {r.conv_id: r.partner_id for r in found.collect()} == wanted
    assert tested.count() <= 0.1 * 1200 * 1199 / 2
    heads = C._blocks(vectors, 100, C.choose_heads(vectors, 0.8)).select(F.length("heads")).collect()
    assert max(r[0] for r in heads) < 8 << 20


def test_rows_whose_first_candidates_fail_ask_again(spark, monkeypatch):
    """Heads of one coordinate let nearly all pairs pass; many rounds find the same rows."""
    rows = rows_of(wide(160, 16))
    df = spark.createDataFrame(rows, SCHEMA)
    vectors = stage_table(D._distinct_vectors(df).withColumn("late", F.lit(True)), "vectors")
    monkeypatch.setattr(C, "choose_heads", lambda v, _: np.eye(16)[:, :1])
    monkeypatch.setattr(C, "_CELL_BYTES", 4 * 30 * 2)
    monkeypatch.setattr(C, "_TESTS_PER_SALT", 20)
    found, tested = C.earliest_partners(vectors, 0.7, 30)
    assert {r.conv_id: r.partner_id for r in found.collect()} == brute_force(rows, 0.7)
    assert tested.groupBy("conv_id", "partner_id").count().where("count > 1").isEmpty()


def test_a_group_of_near_copies_costs_few_tests(spark):
    rng = np.random.default_rng(9)
    one = rng.normal(size=32)
    rows = rows_of([one + 0.01 * rng.normal(size=32) for _ in range(900)])
    df = spark.createDataFrame(rows, SCHEMA)
    vectors = stage_table(D._distinct_vectors(df).withColumn("late", F.lit(True)), "vectors")
    found, tested = C.earliest_partners(vectors, 0.9, 100)
    assert found.count() == 899 and tested.count() <= 2 * 900


def independent(rows, threshold):
    """Greedy over the order: a row stays if no staying row of its bin is near."""
    kept = []
    for i, s, b, v in sorted(rows, key=lambda r: (r[1], r[0])):
        x = np.array(v)
        n = np.linalg.norm(x)
        x = x / n if n else x
        if not any(b == c and float(x @ y) > threshold for _, c, y in kept):
            kept.append((i, b, x))
    return {i for i, *_ in kept}


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95])
def test_independent_survivors_against_greedy(spark, threshold):
    rng = np.random.default_rng(23)
    angles = np.cumsum(rng.uniform(0, 0.35, size=60))  # long chains round the circle
    vectors = [[math.cos(a), math.sin(a)] for a in angles]
    vectors += [vectors[5]] * 20 + [[0.0, 0.0]] * 2
    bins = [i % 2 for i in range(len(vectors))]
    sizes = [int(x) for x in rng.integers(0, 12, size=len(vectors))]
    rows = rows_of(vectors, bins, sizes)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id for r in D.near_duplicates(df, threshold, 16, "independent").collect()}
    assert got == independent(rows, threshold)


def test_ends_of_a_chain_stay_if_the_middle_goes(spark):
    df = spark.createDataFrame(rows_of([[1, 0], [1, 1], [0, 1]]), SCHEMA)
    got = sorted(r.conv_id for r in D.near_duplicates(df, 0.6, survivors="independent").collect())
    assert got == [0, 2]
    with pytest.raises(ValueError):
        D.near_duplicates(df, 0.6, survivors="all")
    empty = df.where("false")
    assert D.near_duplicates(empty, 0.6, survivors="independent").count() == 0
    assert D.near_duplicates(empty, 0.6).count() == 0


def test_exact_duplicates_keep_the_first(spark):
    c = [("human", "a"), ("gpt", "b")]
    other_roles = [("human", "a"), ("system", "b")]
    rows = [(1, 5, c, "s1"), (2, 4, c, "s2"), (3, 4, c, "s3"), (4, 1, other_roles, "s1")]
    df = spark.createDataFrame(
        rows,
        "conv_id bigint, nbytes bigint, conversation array<struct<from:string,value:string>>, source string",
    )
    once = D.drop_exact_duplicates(df)
    assert sorted((r.conv_id, r.source) for r in once.collect()) == [(2, "s2"), (4, "s1")]
    assert sorted(r.conv_id for r in D.drop_exact_duplicates(once).collect()) == [2, 4]


def test_hashed_bag_counts_tokens(spark):
    df = spark.createDataFrame([("a b a",), ("",)], "v string")
    got = [r.x for r in df.select(E.hashed_bag(F.col("v"), 8).alias("x")).collect()]
    assert [sum(x) for x in got] == [3.0, 0.0] and all(len(x) == 8 for x in got)
    assert max(got[0]) >= 2.0


def test_mean_pool_of_an_empty_mask_is_zero(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 2.0], 1), (1, [3.0, 4.0], 0), (2, [5.0, 5.0], 0)],
        "conv_id bigint, vector array<double>, mask int",
    )
    assert {r.conv_id: r.pooled for r in E.mean_pool(df).collect()} == {1: [1.0, 2.0], 2: [0.0, 0.0]}


def test_precomputed_only_if_complete(spark):
    schema = "conv_id bigint, qa_pair_embeddings array<float>"

    def embed(df):
        return df.withColumn("embedding", F.array(F.lit(9.0)))

    full = spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema)
    part = spark.createDataFrame([(1, [1.0]), (2, None)], schema)
    assert sorted(r.embedding[0] for r in E.with_embeddings(full, embed).collect()) == [1.0, 2.0]
    assert [r.embedding for r in E.with_embeddings(part, embed).collect()] == [[9.0], [9.0]]
