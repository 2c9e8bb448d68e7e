"""Operators on texts against brute force, and their edge rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark import Broadcast
from pyspark.sql import functions as F

from dialoom.llm import common, components, decontaminate, exact_dedup, jaccard_join, language_id
from dialoom.llm import mixing, substring_dedup, wordhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, kept string, bucket int, size int"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    full = [(i, t, lang, source, "x", 1, 2) for i, t, lang, source in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def texts(spark, values, start=0):
    return frame(spark, [(start + i, t, "en", "s") for i, t in enumerate(values)])


def some_words(rng, n, vocabulary=40):
    return [f"W{rng.randrange(vocabulary)}" for _ in range(n)]


EDGES = [None, "", " \t\n\x0b\x0c\r ", "a", "A  b", "a b", "é" * 10, "x" * 20000, "w " * 6000]


# --- exact dedup


def exact_brute(rows):
    norm = {}
    for i, t in rows:
        norm.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    return {
        i: (min(g)[1], len(g), hashlib.sha256(k.encode()).hexdigest())
        for k, g in norm.items()
        for _, i in g
    }


@pytest.mark.parametrize("key_bits", [64, 3])
def test_exact_groups_with_chains_and_splits(spark, key_bits):
    rng = random.Random(1)
    values = EDGES + [" ".join(some_words(rng, rng.randrange(1, 3), 6)) for _ in range(120)]
    values += ["same text"] * 60 + ["sametext "] * 3
    df = texts(spark, values)
    got = exact_dedup.exact_groups(df, capacity=4, key_bits=key_bits).collect()
    want = exact_brute(list(enumerate(values)))
    assert {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in got} == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    assert len(got) == len(values)
    if key_bits == 3:
        assert max(r.chain for r in got) > 1
    assert len({r.bucket for r in got}) > 1


def test_exact_groups_empty_and_null_ids(spark):
    assert exact_dedup.exact_groups(texts(spark, [])).count() == 0
    df = frame(spark, [(None, "a b", None, None), (5, "ab", None, None), (5, "ab", None, None)])
    got = exact_dedup.exact_groups(df).collect()
    assert sorted((r.doc_id is None, r.keep_id, r.group_size) for r in got) == [
        (False, None, 3), (False, None, 3), (True, None, 3),
    ]


# --- word hashes


def test_word_hashes_equal_only_for_equal_words():
    values = ["Ab cd", None, "", "ab\tcd ab", "cd", "é ab"]
    seen = {}
    for lower in (False, True):
        for chunk in wordhash.word_chunks(values, lower):
            for d, row in enumerate(chunk.rows):
                words = WORD.findall(values[row] or "")
                a, b = chunk.first[d], chunk.first[d + 1]
                assert b - a == len(words)
                for w, h in zip(words, chunk.hashes[a:b], strict=True):
                    w = w.lower() if lower else w
                    assert seen.setdefault((lower, w), h) == h
    per_mode = [h for (lower, _), h in seen.items() if not lower]
    assert len(set(per_mode)) == len(per_mode)


# --- Jaccard join


def shingles(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def jaccard_brute(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(rng):
    values = list(EDGES)
    for _ in range(12):
        base = some_words(rng, rng.randrange(4, 160), 500)
        for _ in range(rng.randrange(1, 8)):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(500)}"
            values.append(" ".join(copy))
    chain = some_words(rng, 120, 5000)
    for _ in range(25):  # a path: neighbours link, ends do not
        chain = chain[6:] + some_words(rng, 6, 5000)
        values.append(" ".join(chain))
    return values


@pytest.mark.parametrize(("n", "percent", "hot"), [(4, 85, 64), (5, 80, 3), (2, 50, 2)])
def test_jaccard_components(spark, monkeypatch, n, percent, hot):
    monkeypatch.setattr(jaccard_join, "_HOT", hot)
    monkeypatch.setattr(jaccard_join, "_MEMBERS_PER_TASK", 3)
    monkeypatch.setattr(jaccard_join, "_MORE_HUBS", 1)
    monkeypatch.setattr(jaccard_join, "_STAR_ROUNDS", 1)
    values = near_copies(random.Random(n))
    df = texts(spark, values)
    options = jaccard_join.JaccardOptions(shingle=n, percent=percent)
    got = jaccard_join.jaccard_components(df, options=options).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_brute(
        list(enumerate(values)), n, percent
    )


def test_jaccard_edges(spark):
    assert jaccard_join.jaccard_components(texts(spark, [])).count() == 0
    rows = [(None, "a b c d e f", None, None), (3, "a b c d e f", None, None), (3, "a b c d e f", None, None)]
    got = jaccard_join.jaccard_components(frame(spark, rows)).collect()
    assert sorted(str(r.component_id) for r in got) == ["3", "3", "None"]


def test_sets_of_one_sum_are_told_apart(spark, monkeypatch):
    """With a first sum of two bits nearly all sets clash, and both sums name them."""
    whole = jaccard_join.set_identity
    monkeypatch.setattr(jaccard_join, "set_identity", lambda s: (whole(s)[0] & 3, whole(s)[1]))
    values = near_copies(random.Random(8))
    got = jaccard_join.jaccard_components(texts(spark, values)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_brute(
        list(enumerate(values)), 5, 80
    )


def joined(links):
    """Component of each vertex, by union and find."""
    above = {}

    def root(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for u, v in links:
        if u != v:
            u, v = root(u), root(v)
            above[max(u, v)] = min(u, v)
    return {x: root(x) for x in above}


def test_components_of_links_in_lots(spark, monkeypatch):
    """The driver's memory grows with the rounds: a lot that joins nothing, or that is stars
    already, takes none."""
    written = []
    stage = components.stage_table
    monkeypatch.setattr(components, "stage_table", lambda df, name: written.append(name) or stage(df, name))
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(-20, 20)]
    drawn = [(rng.randrange(60), rng.randrange(-60, 120)) for _ in range(70)]
    lots = [
        (path[::2] + [(90, 91)] * 2, 0),  # stars
        (path[2::4], None),
        ([(-20, -19), (7, 7), (None, 3)], 0),  # nothing new
        ([], 0),
        (path + [(200, 19), (200, 201)], None),
        (drawn, None),
    ]
    parts, links = None, []
    for lot, rounds in lots:
        written.clear()
        df = spark.createDataFrame(lot, "u long, v long")
        parts = components.connected_components(df, parts)
        links += [x for x in lot if None not in x]
        got = parts.collect()
        assert len(got) == len({r.vertex for r in got})
        assert {r.vertex: r.component for r in got} == joined(links)
        assert rounds is None or written.count("edges") == 1 + rounds
        whole = components.connected_components(spark.createDataFrame(links, "u long, v long"))
        assert {r.vertex: r.component for r in whole.collect()} == joined(links)


def test_links_found_later_join_components_found_before(spark, monkeypatch):
    """Each call gets new links only, and what was shipped to tasks is given up."""
    monkeypatch.setattr(jaccard_join, "_HUBS", 1)
    monkeypatch.setattr(jaccard_join, "_MORE_HUBS", 1)
    lots, known, given_up = [], [], []
    found, destroy = jaccard_join.connected_components, Broadcast.destroy

    def watched(links, parts=None):
        lots.append({(r.u, r.v) for r in links.collect()})
        known.append(parts)
        return found(links, parts)

    monkeypatch.setattr(jaccard_join, "connected_components", watched)
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: given_up.append(self) or destroy(self, *a))
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    values = []
    for _ in range(60):
        text = list(base)
        text[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        if rng.random() < 0.5:
            text[rng.randrange(60)] = f"y{rng.randrange(1000)}"
        values.append(" ".join(text))
    options = jaccard_join.JaccardOptions(shingle=2, percent=93)
    got = jaccard_join.jaccard_components(texts(spark, values), options=options).collect()
    sets = [set(zip(v.split(), v.split()[1:])) for v in values]
    near = [
        (i, j) for i in range(60) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 93 * len(sets[i] | sets[j])
    ]
    whole = joined(near)
    assert {r.doc_id: r.component_id for r in got} == {i: whole.get(i, i) for i in range(60)}
    assert len(given_up) == 1 and known[0] is None and None not in known[1:]
    assert all(not a & b for k, a in enumerate(lots) for b in lots[:k])


def test_linked_sets_share_a_key_and_bounds_hold():
    rng = np.random.default_rng(5)
    levels = rng.integers(0, 9, 1 << 16, dtype=np.uint8)
    for percent in (50, 80, 85, 95):
        o = jaccard_join.JaccardOptions(percent=percent)
        for _ in range(150):
            base = rng.integers(0, 2**64, rng.integers(1, 300), dtype=np.uint64)
            other = np.concatenate((base[rng.random(len(base)) < 0.93],
                                    rng.integers(0, 2**64, rng.integers(0, 12), dtype=np.uint64)))
            a, b = np.unique(base), np.unique(other)
            both = len(np.intersect1d(a, b))
            linked = len(b) > 0 and 100 * both >= percent * (len(a) + len(b) - both)
            assert jaccard_join.links(a, b, percent) == linked
            for bits in (None, 64, 1024):
                x, y = jaccard_join.bitmap(a, bits), jaccard_join.bitmap(b)
                assert not linked or jaccard_join.may_link(len(a), x, len(b), y, percent)
            if linked:
                keys = set(jaccard_join.prefix_order(a, levels, o).tolist())
                both = keys & set(jaccard_join.prefix_order(b, levels, o).tolist())
                assert len(both) >= max(o.shared_keys(len(a)), o.shared_keys(len(b)))
                assert abs(jaccard_join.tile_of(len(a), o) - jaccard_join.tile_of(len(b), o)) <= 1


# --- substring dedup


def repeats_brute(rows, window):
    first = {}
    words = {i: WORD.findall(t or "") for i, t in rows}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


@pytest.mark.parametrize(("window", "hot"), [(6, 256), (7, 2)])
def test_repeated_spans(spark, monkeypatch, window, hot):
    monkeypatch.setattr(substring_dedup, "_HOT", hot)
    rng = random.Random(window)
    shared = [some_words(rng, rng.randrange(4, 30), 300) for _ in range(5)]
    values = list(EDGES)
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(0, 4)):
            parts += some_words(rng, rng.randrange(0, 15), 300)
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            parts += s[a:] if rng.random() < 0.5 else s
        values.append(("\n" if rng.random() < 0.3 else " ").join(parts))
    df = texts(spark, values, start=-10)
    done = substring_dedup.repeated_spans(df, options=substring_dedup.RepeatOptions(window))
    want = repeats_brute([(i - 10, t) for i, t in enumerate(values)], window)
    got = done.collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {
        i: w[:3] for i, w in want.items()
    }
    assert any(r.n_removed for r in got)
    applied = df.join(done.select("doc_id", "removed"), "doc_id").select(
        "doc_id", substring_dedup.without_repeats(F.col("text"), F.col("removed")).alias("t")
    )
    assert {r.doc_id: r.t for r in applied.collect()} == {i: w[3] for i, w in want.items()}


def test_repeated_spans_edges(spark):
    assert substring_dedup.repeated_spans(texts(spark, [])).count() == 0
    long = " ".join(str(i) for i in range(60))
    rows = [(None, long, None, None), (1, long, None, None), (1, long, None, None), (2, long, None, None)]
    got = substring_dedup.repeated_spans(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [
        ("1", 0), ("1", 0), ("2", 60), ("None", 0),
    ]


# --- mixing


def water_fill(sizes, weights, repeats):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(order)
    rest = float(total)
    while open_:
        weight = sum(w[s] for s in open_)
        over = {s for s in open_ if rest * w[s] / weight > repeats * sizes[s]}
        if not over:
            target |= {s: rest * w[s] / weight for s in open_}
            break
        target |= {s: float(repeats * sizes[s]) for s in over}
        rest -= sum(repeats * sizes[s] for s in over)
        open_ -= over
    return target


def test_mix_targets_and_copies(spark):
    rng = random.Random(3)
    sources = ["b", "a", None, "é", "tiny", "z", "Z"]
    rows = [(i, None if i == 7 else " ".join(some_words(rng, rng.randrange(0, 60))), "en",
             rng.choice(sources[:4] + ["z", "Z"])) for i in range(600)]
    rows += [(1000, "one two", "en", "tiny"), (1001, "", "en", "tiny")]
    df = frame(spark, rows)
    plan = mixing.plan_mix(df).collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = water_fill(sizes, (5, 2, 1), 3)
    for r in plan:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.copies in (int(r.rate), int(r.rate) + 1) and r.copies <= 3
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s, size in sizes.items():
        if size > 1000:
            taken = sum(r.size * r.copies for r in plan if r.source == s)
            assert taken == pytest.approx(want[s], rel=0.2)
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in plan if r.copies}
    assert mixing.plan_mix(texts(spark, [])).count() == 0
    assert mixing.plan_mix(texts(spark, [None, ""])).select("copies").distinct().collect()[0][0] == 0


# --- decontamination


ITEMS = [
    (1, "A train leaves Paris at 9 and travels 120 km in 2 hours; what is its average speed in total?"),
    (2, "Maria has 12 apples and gives 5 apples to Peter before she buys 12 apples more at the shop"),
    (3, "short item of five words"),
    (4, None),
    (5, ""),
]
DOCS = [
    (1, "Before. " + ITEMS[0][1] + " After."),
    (2, "They said: A train leaves London at 7 and travels 300 miles in 4 hours; what is its average speed in total? Yes."),
    (3, "Now Maria has 30 apples and gives 4 apples to Peter before she buys 30 apples more at the shop today"),
    (4, "Now Maria has 30 apples and gives 4 apples to Peter before she buys 99 apples more at the shop today"),
    (5, "A train leaves on time and travels through the hills and nothing else is known of it at all"),
    (6, None),
    (7, ""),
    (8, "short item of five words"),
    (9, "MARIA HAS!! 12 apples*** and gives 5 apples to Peter before she buys 12 apples more at the shop"),
]


def test_decontamination_by_templates(spark):
    docs = spark.createDataFrame([(*d, 1) for d in DOCS], "doc_id bigint, text string, n_slots int")
    bench = spark.createDataFrame([(*d, "x") for d in ITEMS], "item_id bigint, text string, tpl string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 2), (9, 2)}
    assert got[1, 1].n_changed == 0 and got[2, 1].n_changed > 0 and got[3, 2].n_changed > 0
    none = bench.limit(0)
    assert decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_decontamination_finds_verbatim_passages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    items = [(r.item_id, WORD.findall(r.text)) for r in bench.collect()]
    want = set()
    for r in docs.collect():
        w = WORD.findall(r.text or "")
        grams = {tuple(w[i : i + 14]) for i in range(len(w) - 13)}
        want |= {
            (r.doc_id, i)
            for i, x in items
            if any(tuple(x[k : k + 14]) in grams for k in range(len(x) - 13))
        }
    found = decontaminate.contaminated(docs, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want


def found_pairs(spark, docs, items, **options):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = decontaminate.contaminated(df, bench, **options)
    return {(r.doc_id, r.item_id) for r in got.collect()}


def test_decontamination_of_short_sentences_and_slots_of_other_lengths(spark):
    item = "Anna has 3 apples. Ben has 5. Anna gives Ben 2 apples. How many apples does Anna have now?"
    docs = [
        "Carol has 4 apples. Dan has 7. Carol gives Dan 1 apples. How many apples does Carol have now?",
        "Mary Ann has 4 apples. Dan has 7. Mary Ann gives Dan 1 apples. How many apples does Mary Ann have now?",
        "Question\n" + item,
        # Carol becomes Eve: no consistent replacement
        "Carol has 4 apples. Dan has 7. Eve gives Dan 1 apples. How many apples does Carol have now?",
    ]
    assert found_pairs(spark, docs, [item]) == {(0, 0), (1, 0), (2, 0)}
    item = "The old car drives 5 km in 2 hours and then stops for a while near the big lake"
    docs = ["The old car drives 8km in 30 minutes and then stops for a while near the big lake"]
    assert found_pairs(spark, docs, [item]) == {(0, 0)}


def test_decontamination_of_short_items(spark):
    items = ["What is the capital of the old northern country called?", "Who wrote the long book?", "42"]
    docs = [
        "Question " + items[0] + " Answer",
        "Heading\n" + items[0],
        "Quiz: so what is the capital of the old northern country called then",
        "Question " + items[1] + " Answer",
        "so who wrote the long book",
        "Anna wrote the long book 42",
    ]
    want = {(0, 0), (1, 0), (2, 0), (3, 1), (4, 1)}
    assert found_pairs(spark, docs, items, short_items=True) == want


# --- language identification


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rest = language_id.remainder(F.col("doc_id"))
    got = language_id.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and 150 < len(held) < 350
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    # labels of held-out rows are no input
    changed = docs.withColumn("lang", F.when(rest == 2, F.lit("xx")).otherwise(F.col("lang")))
    again = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify_languages(changed).collect()}
    assert again == {r.doc_id: (r.lang_pred, r.score) for r in got}


def test_language_id_edges(spark):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(
        [(None, "en"), ("", "en"), ("123 !?", "en"), ("the and of", None), ("x" * 50000, "en")]
        + [("the house and the tree of the garden", "en"), ("das haus und der baum im garten", "de")] * 20)]
    rows.append((None, "the and of the", "en", "s"))
    got = language_id.identify_languages(frame(spark, rows)).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [by_id[i].lang_pred for i in range(3)] == ["und"] * 3
    assert by_id[3].lang_pred == "en" and by_id[None].lang_pred == "en"
    assert by_id[None].held_out is False
    assert language_id.identify_languages(texts(spark, [])).count() == 0
    unlabelled = frame(spark, [(1, "abc", None, None)])
    assert language_id.identify_languages(unlabelled).first().lang_pred == "und"


def test_temperature_recovers_a_scale():
    rng = np.random.default_rng(1)
    z = rng.normal(0, 2, (4000, 3))
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert language_id._temperature(z * 4, y) == pytest.approx(4, rel=0.15)


def test_common_helpers(spark):
    df = texts(spark, [" a\tb\x0bc d ", None])
    got = df.orderBy("doc_id").select(
        common.without_spaces(F.col("text")).alias("n"), common.words(F.col("text")).alias("w")
    ).collect()
    assert [r.n for r in got] == ["abc d", ""]
    assert [r.w for r in got] == [["a", "b", "c d"], []]


def test_decontamination_judges_rows_of_one_id_apart(spark):
    words = [f"plain{chr(97 + i)}" for i in range(20)]
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id bigint, text string")
    other = [f"other{chr(97 + i)}" for i in range(8)]
    # five windows each, on one diagonal: together they would be enough
    halves = [(1, " ".join(words[:12])), (1, " ".join(other + words[8:]))]
    whole = [(2, " ".join(words)), (2, " ".join(words)), (None, " ".join(words)), (2, "short")]
    docs = frame(spark, [(i, t, "en", "s") for i, t in halves + whole])
    got = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_windows) for r in got) == [(False, 2, 13), (True, None, 13)]
