"""Readers, writers, the document table, streaming and whole runs."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from dialoom import CurateOptions, FilterOptions, OutputOptions, PreprocessOptions, RewriteOptions
from dialoom.operators import documents as D
from dialoom.operators import rewrite as R
from dialoom.operators.clean import clean, quarantine, require_both_roles
from dialoom.plans.curate import curate
from dialoom.plans.preprocess import preprocess
from dialoom.plans.run import run_directory
from dialoom.session import new_folder, shared_dir, stage_table
from dialoom.sources import records as S
from dialoom.sources import sinks as K
from dialoom.streaming import clean_new_files


def msg(role, text):
    return {"from": role, "value": text}


def record(text, key="conversation", **more):
    return {key: [msg("human", text), msg("gpt", f"answer to {text}")], **more}


@pytest.fixture
def folder(tmp_path):
    files = {
        "a.json": json.dumps([record("a1", source="s", note="kept"), record("a2", "messages")]),
        "both.json": json.dumps(
            [{**record("x", "conversation"), **record("y", "conversations"), **record("z", "messages")}]
        ),
        "broken.json": json.dumps([record("lost")])[:-5],
        "empty.json": "[]",
        "b.jsonl": "\n".join(
            [json.dumps(record("b1")), '{"conversation": [', json.dumps(record("b2", "conversations")), ""]
        ),
        "bare.jsonl": json.dumps(record("c1")["conversation"]) + "\n",
        "train.json": json.dumps([record("own output")]),
        "total.jsonl": json.dumps(record("own output")),
        "extra.json": json.dumps([record("unmodified")]),
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def heads(df):
    return sorted(r.c[0]["value"] for r in df.select(F.col("conversation").alias("c")).collect())


def test_readers(spark, folder):
    skip = [*S.output_names(OutputOptions()), "extra.json"]
    arrays = S.read_json_array(spark, folder, exclude=skip)
    lines = S.read_jsonl(spark, folder, exclude=skip)
    good, bad = quarantine(S.combine_sources(arrays, lines))
    assert heads(good) == ["a1", "a2", "b1", "b2", "c1", "z"]
    assert bad.count() == 2
    assert {r.file_name for r in bad.collect()} == {"broken.json", "b.jsonl"}
    noted = good.where(F.map_contains_key("extras", "note")).first()
    assert noted.extras == {"note": '"kept"'} and noted.source == "s"


def test_record_ids_are_stable_and_unique(spark, folder):
    df = S.read_jsonl(spark, folder)
    named = S.with_record_ids(quarantine(df.unionByName(df))[0])
    first = sorted(r.conv_id for r in named.collect())
    assert len(set(first)) == len(first)
    for parts in (1, 3, 8):
        again = S.with_record_ids(quarantine(df.unionByName(df).repartition(parts))[0])
        assert sorted(r.conv_id for r in again.collect()) == first


def test_null_texts_and_bad_side_fields(spark, tmp_path):
    turns = [msg("human", "q"), msg("gpt", "a")]
    rows = [
        {"messages": turns, "id": "k1", "topic": {"x": 1}, "nbytes": "12x"},
        {"messages": turns, "qa_pair_embeddings": ["a"]},
        {"messages": [msg("human", "q"), msg("gpt", None)]},
        {"messages": [msg(None, "q"), msg("gpt", "a")]},
        {"messages": "none"},
    ]
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")
    (tmp_path / "split=x").mkdir()
    (tmp_path / "split=x" / "b.jsonl").write_text("{}", encoding="utf-8")
    good, bad = quarantine(S.read_jsonl(spark, str(tmp_path)))
    extras = sorted((dict(r.extras) for r in good.collect()), key=len)
    assert extras == [{}, {"id": '"k1"', "topic": '{"x":1}'}]
    assert all(r.qa_pair_embeddings is None for r in good.collect())
    assert bad.count() == 3
    assert S.read_json_array(spark, str(tmp_path)).count() == 0


def test_write_and_read_back(spark, folder):
    good, _ = quarantine(S.read_jsonl(spark, folder, exclude=["total.jsonl"]))
    df = S.with_record_ids(good)
    done = preprocess(df, PreprocessOptions())
    split = done.withColumn("split", F.lit("train"))
    path = new_folder(spark, "out")
    K.write_splits(done, split, path)
    again = S.read_jsonl(spark, f"{path}/jsonl/split=train", "*.txt")
    assert heads(again) == heads(done)
    full = spark.read.json(f"{path}/json/split=total")
    assert set(full.columns) >= {"conv_id", "conversation", "nbytes"}
    with pytest.raises(Exception, match="already exists"):
        K.write_records_json(done, f"{path}/json/split=total")


def simple(spark, n, offset=0):
    rows = [
        (offset + i, json.dumps([msg("human", f"question {i} " * (i + 1)), msg("gpt", f"reply {i}")]))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "conv_id bigint, c string").select(
        "conv_id", F.from_json("c", "array<map<string,string>>").alias("conversation")
    )


def test_upsert_twice(spark):
    path = new_folder(spark, "store")
    docs = D.build_documents(preprocess(simple(spark, 5)))
    more = D.build_documents(preprocess(simple(spark, 6)))
    assert D.upsert_documents(docs, path) == 5
    assert D.upsert_documents(docs, path) == 0
    assert D.upsert_documents(more, path) == 1
    assert D.upsert_documents(more.unionByName(more), path) == 0


def test_document_terms(spark):
    row = D.build_documents(preprocess(simple(spark, 1))).first()
    tokens = f"{row.system_prompt} {row.human} {row.gpt}".split()
    assert row.term_frequencies == {t: tokens.count(t) for t in tokens}
    assert row.document_length == len(tokens)


def make_generator():
    return lambda prompts: [f"New System Prompt: {'long enough' if 'reply 1' in p else 'short'}" for p in prompts]


def test_rewrite_accepts_long_results_only(spark):
    df = preprocess(simple(spark, 3))
    done = R.improve_system_prompts(df, make_generator, RewriteOptions())
    got = {r.conv_id: r.conversation[0]["value"] for r in done.collect()}
    assert got[1] == "long enough"
    assert got[0] == got[2] == PreprocessOptions().system_prompt


@pytest.mark.parametrize(("length", "accepted"), [(10, False), (11, True)])
def test_accept_limit(spark, length, accepted):
    df = preprocess(simple(spark, 1)).select(
        R.accept_rewrite(F.col("conversation"), F.lit("x" * length)).alias("c")
    )
    assert (df.first().c[0]["value"] == "x" * length) is accepted


def test_failed_generation_keeps_the_record(spark):
    df = preprocess(simple(spark, 2))
    done = R.improve_system_prompts(df, lambda: lambda ps: [None] * len(ps), RewriteOptions(twice=True))
    assert sorted(map(str, done.collect())) == sorted(map(str, df.collect()))


def test_streaming_equals_batch(spark):
    source, target, state = (new_folder(spark, x) for x in ("in", "out", "state"))
    first, second = simple(spark, 4), simple(spark, 3, offset=100)
    first.write.parquet(source)
    clean_new_files(spark, source, target, state, first.schema)
    assert spark.read.parquet(target).count() == 4
    second.write.mode("append").parquet(source)
    clean_new_files(spark, source, target, state, first.schema)
    batch = require_both_roles(clean(first.unionByName(second)))
    got = spark.read.parquet(target).select(*batch.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured or spark.sparkContext.getCheckpointDir())
    staged = stage_table(simple(spark, 2), f"t-{uuid.uuid4().hex}")
    assert staged.count() == 2 and shared_dir(spark) in staged.inputFiles()[0]


@pytest.mark.parametrize("balance", [True, False])
def test_curate(spark, balance):
    df = simple(spark, 40)
    df = df.unionByName(df.withColumn("conv_id", F.col("conv_id") + 1000))
    extra = spark.createDataFrame(
        [(9001, [("human", "raw"), ("gpt", "  kept as it is  ")])],
        "conv_id bigint, conversation array<struct<from:string,value:string>>",
    )
    options = CurateOptions(
        filtering=FilterOptions(dedup=True, thin=True, similarity_threshold=0.999, boost=0.0),
        output=OutputOptions(balance=balance, test_ratio=0.25),
        swaps={"reply": ["response"]},
        embedding_dimensions=16,
        store_path=new_folder(spark, "store"),
    )
    done = curate(df, options, unmodified=extra)
    assert done.counts["input"] == 80
    assert done.counts["preprocessed"] == done.counts["stored"] == 40
    rows = done.split.collect()
    ids = [r.conv_id for r in rows]
    assert len(ids) == len(set(ids)) and {r.split for r in rows} == {"train", "test"}
    total = {r.conv_id: r for r in done.total.collect()}
    assert set(ids) == set(total)
    if not balance:
        assert total[9001].conversation[1]["value"] == "  kept as it is  "
    assert all("response" in r.conversation[-1]["value"] for i, r in total.items() if i != 9001)


def test_curate_of_nothing(spark):
    done = curate(simple(spark, 1).where("false"), CurateOptions(output=OutputOptions(balance=True)))
    assert done.total.count() == 0 and done.split.count() == 0


def test_run_over_a_folder_twice(spark, folder):
    """Own outputs lie in the folder; a second run reads and writes the same."""
    options = CurateOptions(output=OutputOptions(test_ratio=0.5))
    found = []
    for _ in range(2):
        run_directory(spark, folder, options, unmodified=["extra.json"])
        lines = spark.read.text(f"{folder}/curated/jsonl")
        found.append(sorted((r.split, r.value) for r in lines.collect()))
    assert found[0] == found[1]
    total = [v for s, v in found[0] if s == "total"]
    assert len(total) == 7 and not any("own output" in v for v in total)
    assert any('"unmodified"' in v for v in total)


def test_rewriting_needs_a_generator(spark):
    with pytest.raises(ValueError, match="generator"):
        curate(simple(spark, 1), CurateOptions(rewrite=RewriteOptions(enabled=True)))


def test_curate_goes_on_after_a_stop(spark):
    path = new_folder(spark, "rewritten")
    options = CurateOptions(rewrite=RewriteOptions(enabled=True), rewrite_path=path)
    first = curate(simple(spark, 4), options, make_generator=make_generator)

    def never():
        raise AssertionError("all has been generated")

    again = curate(simple(spark, 4), options, make_generator=lambda: lambda prompts: never())
    assert sorted(map(str, first.total.select("conversation").collect())) == sorted(
        map(str, again.total.select("conversation").collect())
    )
