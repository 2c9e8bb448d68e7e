"""The filter audit and periodic runs against brute force, and their edge rows."""

from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialoom.llm import filter_audit as A
from dialoom.llm import periodic_runs as P
from dialoom.llm import registered

DOCS = "doc_id long, text string, source string, part string, mask string"
LABELS = "doc_id long, quality int, toxic int, digest string"


def brute_runs(words, min_length):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if end - start >= max(min_length, 2 * q):
                found.setdefault((start, end), q)  # smaller periods come first
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_left(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def runs_of(texts, min_length):
    return [
        ([tuple(map(int, r)) for r in zip(s, n, q, strict=True)], left)
        for s, n, q, left in P.text_runs(texts, min_length)
    ]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="abc", max_size=60), min_size=1, max_size=4), st.sampled_from([2, 5, 12]))
def test_runs_of_random_texts(texts, min_length):
    for text, (runs, left) in zip(
        texts, runs_of([" ".join(t) for t in texts], min_length), strict=True
    ):
        want = brute_runs(list(text), min_length)
        assert runs == want
        assert left == brute_left(list(text), want)


def test_runs_of_all_short_binary_texts():
    texts = ["".join(t) for n in range(1, 14) for t in itertools.product("ab", repeat=n)]
    got = runs_of([" ".join(t) for t in texts], 2)
    assert [r for r, _ in got] == [brute_runs(list(t), 2) for t in texts]


def test_runs_of_structured_texts():
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 400:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    rng = np.random.default_rng(3)
    texts = [fibonacci[-1], "a" * 300, "aab" * 50 + "aaab" * 40, "ab" * 70 + "c" + "ab" * 70]
    for _ in range(60):
        base = "".join(rng.choice(list("ab"), rng.integers(1, 30)))
        texts.append(base * int(rng.integers(2, 8)) + base[: rng.integers(0, len(base))] + "ba" * 9)
    got = runs_of([" ".join(t) for t in texts], 12)
    assert [r for r, _ in got] == [brute_runs(list(t), 12) for t in texts]


def test_one_word_many_times_is_linear():
    [(runs, left)] = runs_of(["la " * 300_000], 12)
    assert runs == [(0, 300_000, 1)] and left == "la"


def test_edge_rows_of_runs(spark):
    rows = [
        (1, None, "s"), (2, "", "s"), (3, "x " * 12, None), (3, "x " * 12, None), (None, "y " * 11, "s"),
        (4, "\x0bä\x0cb\t" * 6, "s"), (5, "a b " * 20 + "c", "s"),
    ]
    docs = spark.createDataFrame([(*r, "p", "m") for r in rows], DOCS)
    got = {
        (r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in P.periodic_runs(docs).collect()
    }
    assert got == {
        (1, ""): [], (2, ""): [], (3, "x"): [(0, 12, 1)], (None, " ".join("y" * 11)): [],
        (4, "ä b"): [(0, 12, 2)], (5, "a b c"): [(0, 20, 1)],
    }
    assert P.periodic_runs(docs.limit(0)).collect() == []


def test_query_of_runs_against_brute_force(spark, tmp_path):
    source = "/root/testdata/sf0.001/documents.parquet"
    docs = spark.read.parquet(source).limit(40).unionByName(
        spark.createDataFrame([(None, "a b " * 9, "en", "s", 9), (10**6, None, "en", "s", 0)],
                              "doc_id long, text string, lang string, source string, n_chars long")
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for row in docs.collect():
        words = (row.text or "").encode().split()
        words = [w.decode() for w in words]
        n = len(words)
        if row.doc_id is not None and n:
            h = zlib.crc32(str(row.doc_id).encode())
            g = h // 10
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words, 12)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        want[row.doc_id] = (
            len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(brute_left(words, runs).encode()).hexdigest(),
        )
    done = registered.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert dict(done.dtypes)["exponent_milli"] == "bigint"
    assert {r[0]: tuple(r[1:]) for r in done.collect()} == want
    assert any(v[0] for v in want.values())


def brute_audit(rows, labels, letters="ABCDE"):
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    docs = []
    for doc_id, text, part in rows:
        t = text or ""
        words = [w.decode() for w in t.encode().split()]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": doc_id is not None and doc_id > first[t],
        }
        good = any(i == doc_id and q == 1 for i, q, _ in labels if i is not None)
        toxic = any(i == doc_id and x == 1 for i, _, x in labels if i is not None)
        docs.append((part or "", fails, good, toxic))
    out, removed = {}, {}
    for part in {d[0] for d in docs}:
        for order in map("".join, itertools.permutations(letters)):
            for step, letter in enumerate(order, 1):
                mine = [d for d in docs if d[0] == part]
                alive = [d for d in mine if not any(d[1][c] for c in order[: step - 1])]
                here = [d for d in alive if d[1][letter]]
                failing = [d for d in mine if d[1][letter]]
                out[part, order, step] = (
                    len(alive) - len(here), len(here), len(failing) - len(here),
                    sum(sum(d[1].values()) == 1 for d in failing),
                    sum(d[2] for d in here), sum(d[3] for d in here),
                )
                key = part, letter
                removed[key] = removed.get(key, 0) + len(here)
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


AUDIT_ROWS = [
    (1, "Word " * 250, "s"), (2, "Word " * 250, "t"), (2, "Word " * 250, "t"), (3, None, None),
    (4, "", "s"), (5, " ".join(f"w{i}" for i in range(300)), "s"), (6, "a # b", ""),
    (7, " ".join(f"w{i}" for i in range(300)), "t"), (None, "", "s"), (None, "ABC", "s"),
    (8, " ".join(f"W{i}|" for i in range(9000)), "t"), (9, "ABC", "s"), (9, "ABC", "t"),
]
AUDIT_LABELS = [(1, 1, 0), (1, 0, 1), (4, 1, 1), (7, 1, 0), (9, None, 1), (None, 1, 1), (99, 1, 1)]


def audited(spark, rows, labels, **more):
    docs = spark.createDataFrame([(*r, "p", "m") for r in rows], DOCS)
    marks = spark.createDataFrame([(*r, "d") for r in labels], LABELS)
    return A.audit_filters(docs, marks, **more)


def test_audit_against_brute_force(spark):
    got = audited(spark, AUDIT_ROWS, AUDIT_LABELS).collect()
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == brute_audit(AUDIT_ROWS, AUDIT_LABELS)
    assert len(got) == 3 * 120 * 5


def test_audit_of_empty_tables(spark):
    assert audited(spark, [], AUDIT_LABELS).collect() == []
    got = audited(spark, AUDIT_ROWS, []).collect()
    assert all(r.good_lost == r.toxic_lost == 0 for r in got) and len(got) == 1800


def test_audit_of_own_filters(spark):
    own = {"x": F.col("text").contains("a"), "y": F.size("words") == 0}
    got = audited(spark, AUDIT_ROWS, [], filters=own, duplicates=None).collect()
    assert {r.filter_order for r in got} == {"xy", "yx"}
    empty = {r.step: r for r in got if r.part == "" and r.filter_order == "yx"}
    assert (empty[1].removed, empty[2].removed, empty[2].kept) == (1, 1, 0), empty
    with pytest.raises(ValueError, match="letters"):
        A.prefix_steps(spark.range(1).withColumnRenamed("id", "mask"), "ABCDEFG")


def test_recursion_does_not_grow_with_the_data(spark):
    masks = spark.range(32).select(F.col("id").cast("int").alias("mask"))
    assert A.prefix_steps(masks, "ABCDE").count() == 32 * 325
