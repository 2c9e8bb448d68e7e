"""Bins, balancing, splits and ranks."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialoom.operators import balance as L
from dialoom.operators import bins as B
from dialoom.operators import split as S
from dialoom.operators.ranking import rank_by_range, rank_in_groups


def sizes(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "conv_id bigint, nbytes bigint")


def numpy_bins(values, n):
    edges = np.linspace(min(values), max(values), n + 1)
    return list(np.digitize(np.array(values), edges) - 1)


@pytest.mark.parametrize("n", [1, 2, 7, 40])
@pytest.mark.parametrize("values", [[5], [5, 5], list(range(100)), [3, 1000, 17, 17, 999, 500]])
def test_assign_bins(spark, values, n):
    low, high, _ = B.size_range(sizes(spark, values))
    df = B.assign_bins(sizes(spark, values), B.Binning(n, low, high))
    got = [r.bin for r in df.orderBy("conv_id").collect()]
    assert got == numpy_bins(values, n)


def search(values):
    """The search over bin numbers, as a loop."""
    best, lowest = None, math.inf
    for n in range(2, max(values) + 1):
        counts = np.bincount(numpy_bins(values, n), minlength=n)
        average = counts.sum() / np.count_nonzero(counts)
        deviation = np.std(counts)
        score = max(average / n, min(values)) / deviation if deviation else math.inf
        if score < lowest - 1e-12:
            lowest, best = score, n
        if n > average:
            break
    return best


@pytest.mark.parametrize("seed", range(6))
def test_optimal_bins(spark, seed):
    rng = random.Random(seed)
    values = [int(rng.lognormvariate(3, 1)) + 2 for _ in range(rng.randint(3, 300))]
    df = sizes(spark, values)
    assert B.optimal_bins(df, chunk=3).nbins == search(values)
    assert B.optimal_bins(df).nbins == search(values)


def test_optimal_bins_corner_cases(spark):
    assert B.optimal_bins(sizes(spark, [7])).nbins == search([7])
    assert B.optimal_bins(sizes(spark, [7] * 9)).nbins == search([7] * 9)
    assert B.optimal_bins(sizes(spark, [1, 5, 9]), force=12).nbins == 12
    # one record in each of the three bins: nothing to prefer
    even = B.optimal_bins(sizes(spark, [2, 3, 4]), chunk=1)
    assert even is not None


def test_optimal_bins_empty(spark):
    assert B.optimal_bins(spark.createDataFrame([], "conv_id bigint, nbytes bigint")) is None


def balance_loop(values, nbins, include_max):
    """Numbers of own and filled-in records per bin, as a loop over the bins."""
    target = math.ceil(len(values) / nbins)
    n = min(nbins, max(values) - min(values))
    bins = numpy_bins(values, n)
    if include_max:
        bins = [min(b, n - 1) for b in bins]
    counts = collections.Counter(b for b in bins if b < n)
    pool, filled = 0, []
    for b in range(n):
        own = min(counts[b], target)
        taken = min(target - own, pool)
        pool += counts[b] - own - taken
        filled.append(own + taken)
    return target, filled


@pytest.mark.parametrize("include_max", [True, False])
@pytest.mark.parametrize("seed", range(4))
def test_balance(spark, seed, include_max):
    rng = random.Random(seed)
    values = [int(rng.lognormvariate(4, 1)) for _ in range(200)]
    if seed == 3:
        values = [10] * 150 + list(range(11, 61))  # a third and more in the first bin
    nbins = 7
    balanced, target = L.balance_bins(sizes(spark, values), nbins, 1, include_max)
    rows = balanced.collect()
    wanted_target, filled = balance_loop(values, nbins, include_max)
    got = collections.Counter(r.target_bin for r in rows)
    assert target == wanted_target
    assert [got[b] for b in range(len(filled))] == filled
    assert sorted(r.position for r in rows) == list(range(len(rows)))
    assert len({r.conv_id for r in rows}) == len(rows)
    assert all(r.bin <= r.target_bin for r in rows)
    # positions follow the bins
    order = [r.target_bin for r in sorted(rows, key=lambda r: r.position)]
    assert order == sorted(order)


def test_balance_of_one_size_is_the_input(spark):
    balanced, target = L.balance_bins(sizes(spark, [5] * 10), 4)
    assert balanced.count() == 10 and target == 10


def test_curriculum_keeps_chunks(spark):
    values = [random.Random(8).randint(1, 99) for _ in range(100)]
    balanced, target = L.balance_bins(sizes(spark, values), 6, 1)
    before = {r.conv_id: r.position // target for r in balanced.collect()}
    after = L.curriculum_shuffle(balanced, target, 1).collect()
    assert {r.conv_id: r.chunk for r in after} == before
    assert sorted(r.position for r in after) == list(range(len(before)))
    assert all(r.position // target == r.chunk for r in after)


@pytest.mark.parametrize(("n", "nbins"), [(20, 6), (3, 6), (12, 4)])
def test_split_by_segment(spark, n, nbins):
    df = sizes(spark, range(n)).withColumn("position", F.col("conv_id"))
    rows = S.split_by_segment(df, nbins, 0.25, 1).collect()
    size = n // nbins
    counts = collections.Counter(r.segment for r in rows)
    wanted = [size] * (nbins - 1) + [n - size * (nbins - 1)]
    assert [counts[i] for i in range(nbins)] == wanted
    for i in range(nbins):
        tests = sum(r.split == "test" for r in rows if r.segment == i)
        assert tests == int(counts[i] * 0.25)


def test_split_by_size_bin(spark):
    values = [1, 2, 3, 50, 60, 100, 100]
    rows = S.split_by_size_bin(sizes(spark, values), 2, 0.5, 1, include_max=False).collect()
    assert sorted(r.conv_id for r in rows) == [0, 1, 2, 3, 4]
    rows = S.split_by_size_bin(sizes(spark, values), 2, 0.5, 1).collect()
    assert sorted(r.conv_id for r in rows) == list(range(7))
    assert sum(r.split == "test" for r in rows) == 1 + 2


def test_ranks(spark):
    rng = random.Random(9)
    # one value and one group hold most of the rows
    rows = [(i, 0 if rng.random() < 0.7 else rng.randint(0, 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "conv_id bigint, nbytes bigint").repartition(7)
    got = {r.conv_id: r["rank"] for r in rank_by_range(df, ["nbytes", "conv_id"]).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    assert got == {r[0]: k for k, r in enumerate(order)}

    ranked = rank_in_groups(
        df.withColumn("g", F.col("conv_id") % 2),
        "g",
        F.md5(F.col("conv_id").cast("string")),
        ["conv_id"],
        first=F.col("nbytes"),
    ).collect()
    import hashlib

    for g in (0, 1):
        mine = sorted(
            (r for r in rows if r[0] % 2 == g),
            key=lambda r: (r[1], hashlib.md5(str(r[0]).encode()).hexdigest()),
        )
        assert {r.conv_id: r["rank"] for r in ranked if r.g == g} == {
            r[0]: k + 1 for k, r in enumerate(mine)
        }


def test_results_do_not_depend_on_partitioning(spark):
    values = [random.Random(4).randint(1, 400) for _ in range(150)]

    def run(partitions, shuffle):
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        try:
            df = sizes(spark, values).repartition(partitions)
            balanced, target = L.balance_bins(df, 5, 3)
            done = S.split_by_segment(L.curriculum_shuffle(balanced, target, 3), 5, 0.2, 3)
            return sorted((r.conv_id, r.position, r.split) for r in done.collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert run(1, "3") == run(9, "16")


def test_histogram_filter_keeps_small_bins(spark):
    rng = np.random.default_rng(2)
    counts = {0: 40, 1: 2, 2: 1, 3: 3}
    rows = []
    for b, n in counts.items():
        for _ in range(n):
            rows.append((len(rows), b * 10 + 1, b, [float(x) for x in rng.normal(size=4)]))
    df = spark.createDataFrame(
        rows, "conv_id bigint, nbytes bigint, bin bigint, embedding array<double>"
    )
    kept = collections.Counter(r.bin for r in B.histogram_filter(df, 4, 1.0, "kl", "ner").collect())
    # targets by rank: 4, 3, 2, 1; two stages of int(n * sqrt(ratio))
    n1 = int(40 * math.sqrt(4 / 40))
    assert kept[0] == int(n1 * math.sqrt(4 / 40))
    assert (kept[1], kept[2], kept[3]) == (2, 1, 3)


def test_size_histogram(spark):
    rows = B.size_histogram(sizes(spark, [0, 1, 2, 3, 4]), 2).orderBy("bin").collect()
    assert [(r.cnt, r.size_range) for r in rows] == [(2, "0-2"), (3, "2-4")]
    assert [len(r.bar) for r in rows] == [66, 100]
    assert B.size_histogram(sizes(spark, [5, 5]), 3).count() == 0
