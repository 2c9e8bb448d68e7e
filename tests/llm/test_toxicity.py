"""The recurrent network: gradients, windows against a plain version, held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from dialoom.llm import toxicity as T

SMALL = T.ToxicityOptions(
    window=7, stride=4, hidden=3, attention=4, word_bits=5, char_bits=6, word_size=2, char_size=3,
    epochs=2, min_steps=4,
)


def weights(options):
    return {k: v.astype(np.float64) for k, v in T._initial(options).items()}


def test_gradients():
    p, rng = weights(SMALL), np.random.default_rng(0)
    table = np.concatenate((np.zeros((1, 2, 9)), rng.normal(size=(6, 2, 9))))
    ids = rng.integers(1, 7, size=(5, 7))
    ids[1, 5:], ids[2, 1:], ids[3] = 0, 0, 0
    y = np.array([0, 1, 1, 0, 1])

    def loss():
        z = T._forward(p, table, ids)
        return float((np.logaddexp(0, z) - y * z).sum())

    z, kept = T._forward(p, table, ids, keep=True)
    g, d_table = T._backward(p, kept, 1 / (1 + np.exp(-z)) - y, table)
    pairs = [(p[k], g[k]) for k in ("u", "a", "c", "v", "out", "bias")] + [(table[1:], d_table)]
    for values, gradient in pairs:
        flat = values.reshape(-1)
        for i in rng.integers(len(flat), size=6):
            at = np.unravel_index(i, values.shape)
            old, e = values[at], 1e-3
            values[at] = old + e
            up = loss()
            values[at] = old - e
            down = loss()
            values[at] = old
            assert (up - down) / (2 * e) == pytest.approx(gradient[at], abs=2e-4)


def plain_score(p, o, text):
    """One window at a time, one token at a time."""
    tokens = [t for piece in T.token_pieces(text) for t in piece]
    starts, at = [0], 0
    while at + o.window < len(tokens):
        at += o.stride
        starts.append(at)
    found = []
    for start in starts:
        part = tokens[start : start + o.window]
        rows = [T._project(p, T._inputs(p, T.token_features([t], o)))[1] for t in part]
        table = np.stack([np.zeros((2, 3 * o.hidden))] + rows)
        ids = np.zeros((1, o.window), dtype=np.int32)
        ids[0, : len(part)] = np.arange(1, len(part) + 1)
        found.append(T._forward(p, table, ids)[0])
    return max(found)


@pytest.mark.parametrize("group, piece", [(1 << 17, 1 << 16), (40, 19), (1, 1)])
def test_all_windows_of_every_text(monkeypatch, group, piece):
    monkeypatch.setattr(T, "_GROUP_TOKENS", group)
    monkeypatch.setattr(T, "_PIECE_TOKENS", piece)
    monkeypatch.setattr(T, "_CACHE", 60 if group < 100 else 1 << 10)
    rng, p = np.random.default_rng(1), T._initial(SMALL)
    vocabulary = [f"w{i}," if i % 3 else f"Ä{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in [*range(0, 24), 60, 41]]
    texts += [None, "", "   ", "!!!", "x" * 200, "(st*pid), 'w1'", "_ ü"]
    got = T._Scorer(p, SMALL).logits(texts)
    # a cache smaller than a group starts anew within it
    assert got == pytest.approx([plain_score(p, SMALL, t) for t in texts], abs=1e-4)


def test_window_starts_cover_every_token():
    for n in range(0, 200):
        starts = T.window_starts(n, SMALL)
        covered = {i for s in starts for i in range(s, s + SMALL.window)}
        assert set(range(n)) <= covered
        assert len(starts) == 1 or starts[-1] < n - (SMALL.window - SMALL.stride)


def test_long_texts_in_bounded_pieces():
    text = "x" * 3_000_000 + " " + "ab cd " * 500_000 + "end"
    pieces = list(T.token_pieces(text))
    assert max(map(len, pieces)) <= T._PIECE_TOKENS
    joined = "".join(t for piece in pieces for t in piece)
    assert joined == text.replace(" ", "")


def made_rows(n):
    rng = np.random.default_rng(5)
    plain = [f"word{i}" for i in range(80)]
    bad = ["nastyone", "nastyly", "foulish"]
    rows = []
    for i in range(n):
        text = list(rng.choice(plain, rng.integers(5, 300)))
        toxic = int(i % 4 == 0)
        if toxic:
            text.insert(int(rng.integers(len(text))), str(rng.choice(bad)))
        rows.append((i, " ".join(text), toxic))
    return rows


def test_edge_rows(spark):
    rows = made_rows(240)
    docs = [(i, t, "d", 1.0) for i, t, _ in rows]
    docs += [(1000, None, "d", 1.0), (1001, "", "d", 1.0), (None, rows[0][1], "d", 1.0)]
    docs += [docs[0], (1002, "foulish " * 90_000, "d", 1.0), (1003, "x" * 2_500_000, "d", 1.0)]
    table = spark.createDataFrame(docs, "doc_id long, text string, toxic string, score double")
    marks = [(i, x, "s") for i, _, x in rows if i % 7] + [(None, 1, "s"), (5, None, "s"), (9, 0, "s")]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, text string")
    options = T.ToxicityOptions()
    out = T.score_toxicity(table, labels, options=options).collect()
    assert out[0].__fields__ == ["doc_id", "held_out", "score", "predicted"]
    assert len(out) == len(docs)
    for r in out:
        crc = zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode())
        assert r.held_out == (crc % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    by_id = {r.doc_id: r.score for r in out}
    assert by_id[None] == by_id[0] and sum(r.doc_id == 0 for r in out) == 2
    assert by_id[1000] == by_id[1001] < 0.7 <= by_id[1002]
    toxic = {i: x for i, _, x in rows}
    mine = [(toxic[r.doc_id], r.score) for r in out if r.held_out and r.doc_id in toxic]
    assert np.mean([(s >= 0.7) == bool(x) for x, s in mine]) > 0.9
    # the same rows in another order and partitioning
    again = T.score_toxicity(table.repartition(7), labels.repartition(3), options=options).collect()
    assert {r.doc_id: r.score for r in again} == pytest.approx(by_id)


def test_tables_without_rows_or_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    schema = "doc_id long, toxic int"
    labels = spark.createDataFrame([(2, 1), (3, 1), (6, 0)], schema)
    assert T.score_toxicity(docs.limit(0), labels).collect() == []
    assert [r.score for r in T.score_toxicity(docs, labels.limit(0)).collect()] == [0.0, 0.0]
    one = T.score_toxicity(docs, spark.createDataFrame([(1, 1), (2, 1)], schema)).collect()
    assert {r.score for r in one} <= {0.0, 1.0}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    labelled = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    out = T.score_toxicity(labelled, labels).join(labels, "doc_id").filter("held_out")
    r = out.selectExpr(
        "avg(CASE WHEN toxic = 1 THEN predicted END) AS caught",
        "avg(CASE WHEN toxic = 0 THEN predicted END) AS wrong",
    ).first()
    assert r.caught > 0.65 and r.wrong < 0.02, r
