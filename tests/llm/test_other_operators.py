"""Chat formatting, personal data, web pages, secrets and the pipeline."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dialoom.llm import chat_format, html_text, pii, registered, secrets

SF = "/root/testdata/sf0.001"


# --- chat formatting


def test_maximal_conversations(spark):
    rng = random.Random(4)
    convs = {}
    for i in range(120):
        convs[i] = [(rng.choice("ab"), rng.choice("xyz")) for _ in range(rng.randrange(1, 6))]
    convs[200], convs[201] = [("user", None)], [("user", ""), (None, "t")]
    rows = [(c, k, r, t, 1) for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, place int")
    plain = {c: tuple((r or "", t or "") for r, t in turns) for c, turns in convs.items()}
    want = {
        c
        for c, t in plain.items()
        if not any(len(o) > len(t) and o[: len(t)] == t for o in plain.values())
        and not any(o == t and i < c for i, o in plain.items())
    }
    got = chat_format.render(chat_format.maximal_conversations(df)).collect()
    assert {r.conv_id for r in got} == want
    for r in got:
        assert r.n_turns == len(plain[r.conv_id])
        assert r.text == "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in plain[r.conv_id])
    assert chat_format.maximal_conversations(df.limit(0)).count() == 0


# --- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii_brute(text):
    found = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if ok:
                found.append((k, *m.span()))
    return sorted(found)


PII_TEXTS = [
    None,
    "",
    "a@b.c%d@e.f x@y@z.com me.too@mail-1.example.co.uk. @a.b a@b",
    "1.2.3.4.5 256.1.1.1 0255.001.2.3 1.2.3 10.0.0.1,10.0.0.2 99999999999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 41111111111111110000 1 2 3",
    "é😀 +1 (743) 555-3824 +49.30.1234567 +1-2 ++12345678 +123456789012345678",
    "+1 (743) 555-3824 4785380592391139",
    "9" * 30000 + " " + "a" * 30000 + "@" + "b." * 5000 + "c",
    "1 " * 5000 + "+" + "1-" * 5000,
]


def test_base_spans_equal_the_stated_patterns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame(
        [(-i - 1, t) for i, t in enumerate(PII_TEXTS)], "doc_id bigint, text string"
    )
    df = docs.unionByName(extra).withColumn("base", F.lit("clash"))
    texts = {r.doc_id: r.text for r in df.collect()}
    got = pii.find_personal_data(df).collect()
    assert len(got) == len(texts)
    for r in got:
        base = sorted((s.kind, s.start, s.end) for s in r.base)
        assert base == pii_brute(texts[r.doc_id]), r.doc_id
        for s in [*r.base, *r.added]:
            assert texts[r.doc_id][s.start : s.end] == s.value
    assert pii.find_personal_data(df.limit(0)).count() == 0


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"note {i}: call me at +1 (202) 555-01{i:02d} today") for i in range(12)]
    rows += [(20, "please call me at 030-1234567 today"), (21, "we sold 1234567 of the things")]
    rows += [(22, "he said: call me at noon"), (23, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: [s.value for s in r.added] for r in pii.find_personal_data(df).collect()}
    assert got[20] == ["030-1234567"]
    assert all(not v for d, v in got.items() if d != 20)


# --- web pages

PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body><header>Site name</header><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies.</div><div id="sidebar"><p>Side text, long. And more.</p></div>
<article><header><h1>Head &amp; title</h1></header><p>First   line
goes on.<p>Second &lt;b&gt; &eacute;<br>third.<ul><li>An item of it.</li></ul>
<aside>Aside.</aside><div class="ad">Buy now.</div><form><label>Mail</label><input></form>
<section class="comments"><p>Nice post, thanks. I agree.</p></section><p>Last one.</p></article>
<!-- <p>hidden</p> --><footer>&copy; me</footer></body></html>"""


def test_main_text_of_a_page(spark):
    df = spark.createDataFrame(
        [(1, "u", PAGE, "c"), (2, "v", None, "c"), (3, "w", "", "c"), (4, None, "<nav>x</nav>", "c"),
         (5, "y", "<article>" + "<p>Word one, two.</p>" * 3000, "c"), (1, "u", PAGE, "c")],
        "page_id bigint, url string, html string, text string",
    )
    got = html_text.extract_main_text(df).collect()
    by_id = {r.page_id: r.text for r in got}
    assert len(got) == 6
    assert by_id[1] == "Head & title\nFirst line goes on.\nSecond <b> é\nthird.\nAn item of it.\nLast one."
    assert by_id[2] == by_id[3] == by_id[4] == ""
    assert by_id[5] == "\n".join(["Word one, two."] * 3000)
    assert html_text.extract_main_text(df.limit(0)).count() == 0


def test_names_of_the_whole_page_and_an_open_head_lose_no_text():
    o = html_text.HtmlOptions()
    said = "A long paragraph, with words. And more of them, as articles have."
    paragraphs = f"<h1>Title</h1><p>{said}</p><p>{said}</p><p>{said}</p>"
    want = "\n".join(["Title", said, said, said])
    side = "<nav><a href=/>Home</a></nav>"
    for page in (
        f"<html class='has-sidebar'><body class='no-sidebar'>{side}{paragraphs}</body></html>",
        f"<body><div class='widget-ready'>{side}<div class='x'>{paragraphs}</div></div></body>",
        f"<html><head><title>T</title><meta charset=utf-8><body>{side}{paragraphs}</body></html>",
        f"<html><head><title>T</title><article>{paragraphs}</article></html>",
    ):
        assert html_text.main_text(page, html_text.PRIOR, o) == want
        assert all(b.label != 0 for b in html_text.page_blocks(page) if b.text == said)
    inner = f"<body><div class='sidebar'><p>{said}</p></div>{paragraphs}</body>"
    assert html_text.main_text(inner, html_text.PRIOR, o) == want
    talk = f"<section class='comments'>{'<p>' + said + '</p>'}</section>"
    for page in (f"<article><p>Short one.</p>{talk}</article>", f"<article><p>Short one.</p></article>{talk}"):
        assert [b.label for b in html_text.page_blocks(page)] == [1, 0]


def test_given_pages_hold_their_articles(spark):
    import html as entities

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    for r in html_text.extract_main_text(pages).collect():
        body = re.search(r"<article>(.*?)(</article>|$)", raw[r.page_id], re.S)[1]
        lines = [
            re.sub(r"\s+", " ", entities.unescape(re.sub("<[^>]*>", "", x))).strip()
            for x in re.split(r"</?(?:p|h1|br)>", body)
        ]
        assert r.text == "\n".join(x for x in lines if x)


def test_minimum_cut_against_all_labellings():
    rng = np.random.default_rng(2)
    for _ in range(150):
        n = int(rng.integers(1, 8))
        costs = rng.normal(0, 2, n).round(2)
        edges = [(i, j, float(rng.random())) for i in range(n) for j in range(i) if rng.random() < 0.6]

        def price(labels, costs=costs, edges=edges):
            lost = sum(abs(c) for c, on in zip(costs, labels, strict=True) if (c > 0) != on)
            return lost + sum(w for a, b, w in edges if labels[a] != labels[b])

        best = min(price(x) for x in itertools.product([True, False], repeat=n))
        assert price(list(html_text.min_cut(costs, edges))) == pytest.approx(best)


# --- secrets


def secrets_brute(text):
    text = text or ""
    out = []
    pattern = (
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    for m in re.finditer(pattern, text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, m.end()))
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secret_base_spans(spark):
    values = [
        None, "", "PassWord: 'abcdef' passwd=abc token = \"" + "0f" * 20 + "\" ſecret=abcdef",
        "AKIA" + "A1" * 8 + " AKIAAAAA", "é😀 api_key:" + "x" * 30000, "Apikey=ab.cd/ef" + " " * 20000,
        "token" * 3000,
    ]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame(
        [(-i - 1, t) for i, t in enumerate(values)], "doc_id bigint, text string"
    )
    df = docs.unionByName(extra).withColumn("candidates", F.lit(1))
    texts = {r.doc_id: r.text for r in df.collect()}
    got = secrets.find_secrets(df).select("doc_id", secrets.base_text(F.col("base")).alias("b")).collect()
    assert {r.doc_id: r.b for r in got} == {i: secrets_brute(t) for i, t in texts.items()}
    assert secrets.find_secrets(df.limit(0)).count() == 0


def random_secret(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_network_finds_secrets_that_no_pattern_states(spark):
    rng = random.Random(8)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = []
    for i in range(150):
        rows.append((i, f"config token = {random_secret(rng, alphabet, 32)} end"))
        rows.append((1000 + i, f"see order 2024-{i:04d}-{rng.randrange(10**6):06d} of build 1.2.{i}.40"))
    rows.append((5000, f"config tokn = {random_secret(rng, alphabet, 32)} end"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in secrets.find_secrets(df).collect()}
    assert len(got[5000].added) == 1
    wrong = sum(bool(r.added) for i, r in got.items() if 1000 <= i < 2000)
    assert wrong == 0


def test_network_gradients():
    o = secrets.SecretOptions(filters=4, embedding=3)
    net = secrets.CharNetwork(o)
    row = ("left ", "abc123XYZ", " r", 1)
    grads = net._gradients(row)

    def loss():
        z = net.logit(*row[:3])
        return np.logaddexp(0, z) - z

    rng = np.random.default_rng(0)
    for name, g in grads.items():
        for _ in range(6):
            at = tuple(int(rng.integers(0, s)) for s in g.shape)
            keep = net.p[name][at]
            net.p[name][at] = keep + 1e-5
            up = loss()
            net.p[name][at] = keep - 1e-5
            down = loss()
            net.p[name][at] = keep
            assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def findings(spark, n):
    """``n`` findings of each label, a row each, in the order in which they were once cut."""
    rng = random.Random(3)
    rows = [
        (i, [], [(0, 12, bool(i % 2), "key ", f"{i:05d}{rng.randrange(10**7):07d}" if i % 2 else f"build-{i:06d}", "")])
        for i in range(2 * n)
    ]
    found = spark.createDataFrame(rows, secrets._FINDINGS)
    c = F.col("candidates")[0]
    return found.orderBy(F.xxhash64(c["left"], c["value"], c["right"])).collect(), found.schema


def test_networks_learn_from_every_finding(spark):
    rows, schema = findings(spark, 1100)
    o = secrets.SecretOptions(filters=3, embedding=3, epochs=1)
    last = max(i for i, r in enumerate(rows) if r.candidates[0].labelled)
    value = rows[last].candidates[0].value

    def trained(chosen):
        return secrets.train_networks(spark.createDataFrame(chosen, schema), o)

    whole, less = trained(rows), trained(rows[:last] + rows[last + 1 :])
    fitted = secrets.half_of(value)
    assert not np.array_equal(whole[fitted].p["out"], less[fitted].p["out"])


def test_networks_of_many_shards(spark):
    rows, schema = findings(spark, 400)
    o = secrets.SecretOptions(filters=4, embedding=4, balance=100, shard=90)
    one, two = (
        secrets.train_networks(spark.createDataFrame(rows, schema).repartition(n), o)
        for n in (2, 7)
    )
    for a, b in zip(one, two, strict=True):
        assert all(np.array_equal(a.p[k], b.p[k]) for k in a.p)
        assert (a.scale, a.threshold) == (b.scale, b.threshold)
    right = 0
    for r in rows:
        c = r.candidates[0]
        network = one[1 - secrets.half_of(c.value)]
        right += (network.probability(c.left, c.value, c.right) >= network.threshold) == c.labelled
    assert right >= 0.97 * len(rows)


def test_settled_by_counts_as_by_rows():
    rng = np.random.default_rng(2)
    z = np.round(np.concatenate((rng.normal(2, 1, 500), rng.normal(-2, 1, 900))), 1)
    y = np.repeat([1, 0], [500, 900])
    nets = [secrets.CharNetwork(secrets.SecretOptions()) for _ in range(2)]
    nets[0].settle(z, y, np.ones(len(z)), np.ones(len(z)))
    pairs, n = np.unique(np.stack((z, y)), axis=1, return_counts=True)
    nets[1].settle(pairs[0], pairs[1], n, np.ones(len(n)))
    assert nets[0].scale == nets[1].scale
    assert nets[0].threshold == pytest.approx(nets[1].threshold)
    keep = np.sort(z[y == 1])[::-1][int(np.ceil(0.98 * 500)) - 1]
    high = np.quantile(z[y == 0], 0.99)
    cut = nets[0].scale * min(keep, (keep + high) / 2)
    assert nets[0].threshold == pytest.approx(1 / (1 + np.exp(-cut)))


def test_threshold_keeps_the_recall_on_held_out_findings():
    class Scored(secrets.CharNetwork):
        def logit(self, left, value, right):
            return float(value)

    rng = np.random.default_rng(5)

    def sample():
        positive = [("", str(z), "", 1) for z in rng.normal(1, 1, 2000)]
        return positive + [("", str(z), "", 0) for z in rng.normal(-1, 1, 2000)]

    net = Scored(secrets.SecretOptions())
    seen, held = sample(), sample()
    net.calibrate(seen)
    for rows, least in ((seen, 0.98), (held, 0.97)):
        scores = [net.probability(*r[:3]) for r in rows if r[3]]
        assert np.mean(np.array(scores) >= net.threshold) >= least


# --- queries and pipeline


def test_query_names():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registered.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    strange = spark.createDataFrame(
        [(90001, None, "en", "s", 0), (90002, "12 34", None, None, 5), (90003, "", "en", "s", 0)],
        docs.schema,
    )
    docs = docs.unionByName(strange)
    columns = docs.columns
    from tests.llm.test_text_operators import exact_brute, jaccard_brute

    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.stage_table(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        after = [(r.doc_id, r.text) for r in docs.collect()]
        ids = [i for i, _ in after]
        if number == 0:
            assert set(before) - set(ids) == {90001, 90002, 90003}
        elif number == 1:
            assert sorted(ids) == sorted({k for k, _, _ in exact_brute(before.items()).values()})
        elif number == 2:
            assert sorted(ids) == sorted({c for _, c in jaccard_brute(before.items(), 5, 80).values()})
        elif number == 3:
            assert set(ids) < set(before)
        else:
            assert set(ids) <= set(before) and max(ids.count(i) for i in set(ids)) <= 3
        assert all(before[i] == t for i, t in after)


def test_pipeline_stages_tell_rows_of_one_id_apart(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    base = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"other{i}" for i in range(60))
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema

    def left(stage, rows):
        df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
        return sorted(
            ((r.doc_id, r.text) for r in stage(spark, df.repartition(3), SF).collect()), key=str
        )

    copies = [(None, base), (None, base), (1, base), (None, other), (7, "a b"), (7, "c d"), (7, "a b")]
    assert left(corpus_pipeline.exact_stage, copies) == sorted(
        [(1, base), (None, other), (7, "a b"), (7, "c d")], key=str
    )
    near = [(None, base), (None, base + " end"), (None, other), (5, other), (5, other), (5, "x y z")]
    kept = left(corpus_pipeline.near_stage, near)
    assert len(kept) == 3 and (5, other) in kept and (5, "x y z") in kept
    leaks = [(None, item), (None, other), (3, item), (3, base)]
    assert left(corpus_pipeline.benchmark_stage, leaks) == sorted([(None, other), (3, base)], key=str)


def test_pipeline_reruns_agree(spark):
    one = sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect())
    two = sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect())
    assert hashlib.sha256(str(one).encode()).digest() == hashlib.sha256(str(two).encode()).digest()


def test_stages_on_repeated_rows_and_without_copies(spark):
    import os

    long = " ".join(f"w{i}" for i in range(40))
    rows = [
        (1, long, "en", "a", None), (1, long, "en", None, 5), (1, long, "en", None, 5),
        (None, long + " end", "en", "a", 1), (None, long + " end", "en", "a", 1),
        (None, long + " end", None, "en", 1),
        (7, "other words here now", "en", "a", 2), (7, "other words here now", "en", "a", 2),
        (8, "", "en", "a", 3), (8, "", "en", "a", 3),
    ]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame(rows, schema)
    names = {"rows", "__row"}
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder))
    exact = sorted(r.doc_id or 0 for r in corpus_pipeline.exact_stage(spark, docs, SF).collect())
    assert exact == [0, 1, 7, 8]
    near = corpus_pipeline.near_stage(spark, docs, SF).collect()
    assert sorted(r.doc_id or 0 for r in near) == [1, 7, 8, 8]
    clean = corpus_pipeline.benchmark_stage(spark, docs, SF).collect()
    assert len(clean) == len(rows)
    made = {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before}
    assert made and not made & names  # no stage writes its input once more


def test_released_tables_go_and_the_others_stay(spark):
    from dialoom.session import Stages, stage_table

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    tables = Stages(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    one, two = tables.table(df, "released"), tables.table(df, "kept")
    again = stage_table(one.join(two.select("k"), "k"), "joined")
    assert spark.conf.get(key, None) == before
    tables.release(one, again)  # the last one is not of these tables
    assert again.count() == 7 and two.count() == 7
    with pytest.raises(Exception, match="(?i)not.exist|not.found|released"):
        spark.read.schema(df.schema).parquet(one.inputFiles()[0]).count()


def test_wanted_texts_are_found_by_flags(spark):
    from dialoom.llm import jaccard_join

    rows = spark.range(20000).select(
        F.when(F.col("id") % 3000 > 0, F.col("id")).alias("doc_id"), F.lit("x").alias("text")
    )
    wanted = spark.range(0, 20000, 250).toDF("doc_id")
    some = {r.doc_id for r in jaccard_join._flagged(rows, wanted).collect()}
    assert {r.doc_id for r in wanted.collect()} - some <= {0, 3000, 6000, 9000, 12000, 15000, 18000}
    assert len(some) < 2000


def test_flags_take_no_python_worker(spark):
    """Rows with and without id, and repeated ids, are dropped as by the join alone, and no
    test by flags asks a Python worker beside that of the operator."""
    from dialoom.llm import jaccard_join
    from dialoom.llm.common import drop_rows, with_flag

    key = F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 5000))
    rows = spark.range(20000).select(key.alias("key"), F.col("id").alias("doc_id"))
    for picked in ("key = 'k17' or key is null", "doc_id % 9 = 0", "doc_id < 0"):
        lost = rows.filter(picked).select("key")
        gone = {r.key for r in lost.collect()}
        left = drop_rows(rows, lost, "key")
        assert left.columns == rows.columns
        assert "Python" not in left._jdf.queryExecution().executedPlan().toString()
        want = sorted(r.doc_id for r in rows.collect() if r.key not in gone)
        assert sorted(r.doc_id for r in left.collect()) == want
        flagged = with_flag(rows, "key", lost, "flag").groupBy("flag").agg(F.count("*").alias("n"))
        passed = {r.flag: r.n for r in flagged.collect()}.get(False, 0)
        assert len(want) * 0.95 <= passed <= len(want)
    some = jaccard_join._flagged(rows, rows.filter("doc_id % 50 = 0").select("doc_id"))
    assert "Python" not in some._jdf.queryExecution().executedPlan().toString()
    assert 400 <= some.count() < 600


def test_join_sends_few_texts_at_a_time(spark, monkeypatch):
    """The bytes of a batch hold while the join runs, and not after it, even if it fails."""
    import pandas as pd

    from dialoom.llm import jaccard_join

    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [len(batch)]})

    def stop(rows, *_):
        long = spark.range(0, 8000, 1, 1).select(F.repeat(F.lit("abcd"), 1000).alias("text"))
        assert 1 < max(r.n for r in long.mapInPandas(sizes, "n long").collect()) <= 1200
        raise InterruptedError

    before = spark.conf.get(key, None)
    monkeypatch.setattr(jaccard_join, "shingle_levels", stop)
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    with pytest.raises(InterruptedError):
        jaccard_join.jaccard_components(docs)
    assert spark.conf.get(key, None) == before
