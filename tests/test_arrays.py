"""Elements of JSON arrays, however the files are split."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from dialoom.operators.clean import quarantine
from dialoom.sources import records as R
from dialoom.sources.arrays import read_elements

HARD = ['}{][,"', "\\", '\\"}', "}}}}", "é}ß日本}", "\n}\t", "", "[{}]", '"', "x" * 700, "},{", "😀}"]


@pytest.fixture
def small_splits(spark):
    """Splits of some bytes, so that records and strings go over many of them."""
    names = {
        "spark.sql.files.maxPartitionBytes": "97",
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    old = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def values(df):
    return sorted(json.dumps(json.loads(r.value)) for r in df.where("whole").collect())


def arrays(seed=3, n=16):
    draw = random.Random(seed)

    def text():
        return "".join(draw.choice(HARD) for _ in range(draw.randrange(4)))

    return [
        {"messages": [{"from": text(), "value": text()} for _ in range(draw.randrange(3))], text(): [[], {}]}
        if i % 5
        else [text(), {"a": [text()]}]
        for i in range(n)
    ]


@pytest.mark.parametrize("style", [{}, {"indent": 2, "ensure_ascii": False}, {"separators": (",", ":")}])
def test_splits_change_nothing(spark, small_splits, tmp_path, style):
    wanted = []
    for k in range(2):
        rows = arrays(k)
        wanted += rows
        (tmp_path / f"{k}.json").write_text(json.dumps(rows, **style) + "\n" * k, encoding="utf-8")
    files = [str(tmp_path / f"{k}.json") for k in range(2)]
    got = read_elements(spark, files)
    assert spark.read.option("lineSep", "}").text(files).rdd.getNumPartitions() > 20
    assert values(got) == sorted(json.dumps(x) for x in wanted)
    assert got.where("NOT whole").isEmpty()


def test_elements_over_many_splits(spark, small_splits, tmp_path):
    rows = [{"v": "}" * 500, "w": "x" * 500}, {"v": {"a": [{}] * 100}}, 7, "a,b", None]
    (tmp_path / "a.json").write_text(json.dumps(rows), encoding="utf-8")
    got = read_elements(spark, [str(tmp_path / "a.json")])
    assert values(got) == sorted(json.dumps(x) for x in rows)


BROKEN = [  # text, numbers of the whole elements, what goes to quarantine
    ("", [], []),
    ("[]", [], []),
    (" [ ] \n", [], []),
    ('[{"a":1},{"b":"}', [1], ['{"b":"}']),
    ('[{"a":1},{"b":2}', [1], ['{"b":2']),
    ('[{"a":1}] tail}', [1], [" tail"]),
    ('head [{"a":1}]', [1], ["head "]),
    ('[{"a":1},,]', [1], []),
    ("[", [], [""]),
    ("no json", [], ["no json"]),
]


@pytest.mark.parametrize("split", [True, False])
def test_broken_files(spark, request, tmp_path, split):
    if split:
        request.getfixturevalue("small_splits")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7")
    files = [str(tmp_path / f"{k}.json") for k in range(len(BROKEN))]
    for path, (text, _, _) in zip(files, BROKEN, strict=True):
        with open(path, "w", encoding="utf-8") as out:
            out.write(text)
    rows = read_elements(spark, files).collect()
    for k, (text, whole, broken) in enumerate(BROKEN):
        mine = [r for r in rows if r.file_name == f"{k}.json"]
        assert [json.loads(r.value)["a"] for r in mine if r.whole] == whole, text
        # a brace cuts what lies outside of the array
        outside = "".join(r.value for r in mine if not r.whole)
        assert outside.replace("}", "") == "".join(broken).replace("}", ""), text
        assert all(r.whole for r in mine) == (not broken), text


def test_a_broken_tail_costs_only_the_tail(spark, small_splits, tmp_path):
    turns = [{"from": "human", "value": "q}"}, {"from": "gpt", "value": 'a "{"'}]
    rows = [{"conversation": turns, "n": i} for i in range(20)]
    text = json.dumps(rows)
    (tmp_path / "whole.json").write_text(text, encoding="utf-8")
    (tmp_path / "cut.json").write_text(text[: text.index('"n": 15') - 30], encoding="utf-8")
    good, bad = quarantine(R.read_json_array(spark, str(tmp_path)))
    counts = {r.file_name: r["count"] for r in good.groupBy("file_name").count().collect()}
    assert counts == {"whole.json": 20, "cut.json": 15}
    assert [r.file_name for r in bad.collect()] == ["cut.json"]
    numbers = good.where("file_name = 'whole.json'").select(F.col("extras")["n"].alias("n"))
    assert sorted(int(r.n) for r in numbers.collect()) == list(range(20))
