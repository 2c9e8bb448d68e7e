"""Ordered sinks, isolated failures of the model, and runs that go on after a stop."""

from __future__ import annotations

import glob
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from dialoom.config import CurateOptions, OutputOptions, RewriteOptions
from dialoom.operators import rewrite as R
from dialoom.plans.curate import curate
from dialoom.session import create_marker, file_names, new_folder
from dialoom.sources import sinks as K


def local(path):
    return path.removeprefix("file:")


def lines_of(path):
    """File by file in the order of the names, without Spark."""
    files = sorted(glob.glob(f"{local(path)}/part-*"), key=os.path.basename)
    return [open(f, encoding="utf-8").read().splitlines() for f in files]


# --- ordered sinks


@pytest.mark.parametrize("n, per_file", [(1000, 64), (5, 100), (0, 10), (130, 13)])
def test_lines_of_the_files_are_in_order(spark, n, per_file):
    df = spark.range(n).repartition(7).withColumnRenamed("id", "position")
    df = df.orderBy(F.xxhash64("position"))
    path = new_folder(spark, "ordered")
    K.write_ordered(df, F.concat(F.lit("p"), F.col("position").cast("string")), path, per_file)
    files = lines_of(path)
    assert [v for f in files for v in f] == [f"p{i}" for i in range(n)]
    if n > per_file:
        assert len([f for f in files if f]) == -(-n // per_file) > 1
    got = K.read_ordered(spark, path).collect()
    assert sorted((r.line_number, r.value) for r in got) == [(i, f"p{i}") for i in range(n)]
    manifest = [json.loads(x) for f in glob.glob(f"{local(path)}/_manifest/*.json") for x in open(f)]
    assert sum(m["lines"] for m in manifest) == n
    assert all(m["first"] // per_file == m["last"] // per_file == m["file"] for m in manifest)


def test_sets_in_one_pass_keep_their_order_with_gaps(spark):
    df = spark.range(400).select(
        (F.col("id") * 3).alias("position"),
        F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"),
    ).repartition(9)
    path = new_folder(spark, "ordered")
    K.write_ordered(df, F.col("position").cast("string"), path, 100, "split")
    for name, keep in (("test", lambda i: i % 5 == 0), ("train", lambda i: i % 5)):
        files = lines_of(f"{path}/split={name}")
        assert len(files) == 12
        assert [int(v) for f in files for v in f] == [3 * i for i in range(400) if keep(i)]
    got = K.read_ordered(spark, path, "split").collect()
    for name in ("test", "train"):
        mine = sorted((r.line_number, int(r.value)) for r in got if r.split == name)
        assert [n for n, _ in mine] == list(range(len(mine)))
        assert [v for _, v in mine] == sorted(v for _, v in mine)


def test_too_many_files_are_refused(spark):
    df = spark.createDataFrame([(10**9,)], "position long")
    with pytest.raises(ValueError, match="more rows per file"):
        K.write_ordered(df, F.lit("x"), new_folder(spark, "ordered"), 10)


def records(spark, n):
    """Sizes that differ, ids that do not follow them."""
    rows = [(f"c{(i * 37) % 1009:04d}", f"question {i} " + "w " * ((i * 53) % 97), f"reply {i}") for i in range(n)]
    return spark.createDataFrame(rows, "conv_id string, q string, a string").select(
        "conv_id",
        F.array(
            F.struct(F.lit("human").alias("from"), F.col("q").alias("value")),
            F.struct(F.lit("gpt").alias("from"), F.col("a").alias("value")),
        ).alias("conversation"),
    )


@pytest.mark.parametrize("balance", [True, False])
def test_curated_sets_are_written_in_order(spark, balance):
    output = OutputOptions(balance=balance, test_ratio=0.25, rows_per_file=10)
    raw = records(spark, 90).withColumn(
        "conversation",
        F.transform(
            "conversation",
            lambda m: F.create_map(F.lit("from"), m["from"], F.lit("value"), m["value"]),
        ),
    )
    done = curate(raw, CurateOptions(output=output))
    path = new_folder(spark, "out")
    K.write_splits(done.total, done.split, path, output)
    rows = sorted(done.total.collect(), key=lambda r: r.position)
    if not balance:
        assert [(r.nbytes, r.conv_id) for r in rows] == sorted((r.nbytes, r.conv_id) for r in rows)
    for name in ("total", "train", "test"):
        want = [r for r in rows if name in ("total", r.split)]
        files = lines_of(f"{path}/json/split={name}")
        got = [json.loads(v) for f in files for v in f]
        assert len([f for f in files if f]) > 3
        assert [g["conv_id"] for g in got] == [r.conv_id for r in want]
        assert not set(got[0]) & set(K.PLACEMENT)
        spoken = [json.loads(v) for f in lines_of(f"{path}/jsonl/split={name}") for v in f]
        assert [m[-1]["value"] for m in spoken] == [r.conversation[-1]["value"] for r in want]


# --- the model


def asked(spark, n, parts=3):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 10 != 9, F.concat(F.lit("prompt "), F.col("id").cast("string"))).alias("prompt")
    ).repartition(parts)


def test_one_bad_prompt_costs_one_record(spark):
    def make():
        def generate(prompts):
            if "prompt 512" in prompts:
                raise RuntimeError("no 512")
            return [p.upper() for p in prompts]

        return generate

    got = {r.id: r for r in R.generate_text(asked(spark, 1000), make, error="error").collect()}
    assert len(got) == 1000
    assert (got[512].raw_output, got[512].error) == (None, "RuntimeError: no 512")
    for i, r in got.items():
        if i != 512:
            assert r.error is None
            assert r.raw_output == (None if i % 10 == 9 else f"PROMPT {i}")


def test_a_failed_prompt_is_tried_again(spark):
    def make(limit):
        seen = {}

        def generate(prompts):
            for p in prompts:
                seen[p] = seen.get(p, 0) + 1
                if p.endswith("3") and len(prompts) == 1 and seen[p] < limit:
                    raise OSError("busy")
                if p.endswith("3") and len(prompts) > 1:
                    raise OSError("busy")
            return [str(len(p)) for p in prompts]

        return generate

    few = asked(spark, 40, 1)
    # halving 16 prompts asks a prompt five times in batches before it is alone
    done = R.generate_text(few, lambda: make(7), error="error", retries=3).collect()
    assert all(r.error is None for r in done)
    lost = R.generate_text(few, lambda: make(99), error="error", retries=3).collect()
    assert {r.id for r in lost if r.error} == {3, 13, 23, 33}


def test_wrong_number_of_answers_is_a_failure(spark):
    done = R.generate_text(asked(spark, 30), lambda: lambda p: p[:1] if len(p) < 5 else p + p, error="e")
    assert all((r.raw_output == r.prompt) and r.e is None for r in done.collect())
    none = R.generate_text(asked(spark, 30), lambda: lambda p: [], error="e").collect()
    assert all((r.e == "ValueError: 0 answers to 1 prompts") == (r.prompt is not None) for r in none)


def test_a_broken_model_stops_the_run(spark):
    def broken(prompts):
        raise RuntimeError("no model")

    frame = R.generate_text(asked(spark, 300, 1), lambda: broken, max_error_share=0.5)
    with pytest.raises(Exception, match="20 of 20 prompts failed|prompts failed, last: RuntimeError"):
        frame.collect()


def test_errors_of_both_passes_are_kept(spark):
    df = sized(spark, 6)

    def make():
        def generate(prompts):
            if any("question 1 " in p and "short answer" not in p for p in prompts):
                raise ValueError("first")
            if any("question 2 " in p and "short answer" in p for p in prompts):
                raise ValueError("second")
            return ["New System Prompt: short answer" for _ in prompts]

        return generate

    done = R.two_pass_generate(df, make, RewriteOptions(twice=True), error="error").collect()
    assert sorted(r.error for r in done if r.error) == ["ValueError: first", "ValueError: second"]
    assert sum(r.generated == "short answer" for r in done) == 4


# --- resuming


def make_counted(folder, limit=None):
    """A model that leaves one file per prompt that it answers, and is gone for good once
    there are ``limit``."""

    def make():
        def generate(prompts):
            if limit is not None and len(os.listdir(folder)) >= limit:
                raise RuntimeError("the model is gone")
            for _ in prompts:
                open(f"{folder}/{uuid.uuid4().hex}", "w").close()
            return ["New System Prompt: I answer briefly" for _ in prompts]

        return generate

    return make


def sized(spark, n):
    with_system = F.concat(
        F.array(F.struct(F.lit("system").alias("from"), F.lit("old").alias("value"))), F.col("conversation")
    )
    return records(spark, n).withColumn("conversation", with_system).withColumn("nbytes", F.lit(100))


def test_slices_before_a_failure_are_kept(spark, tmp_path):
    df, path = sized(spark, 120), new_folder(spark, "rewritten")
    options = RewriteOptions(slices=6, max_error_share=0.2)
    with pytest.raises(Exception, match="failed"):
        R.resume_processing(df, path, make_counted(str(tmp_path), 60), options)
    first = len(os.listdir(tmp_path))
    log = R.SliceLog(spark, path)
    kept = log.read(df.schema).count()
    assert 0 < len(log.folders()) < 6 and 0 < kept < 120
    assert len(file_names(spark, f"{path}/data")) == len(log.folders()) + 1  # an orphan
    done = R.resume_processing(df, path, make_counted(str(tmp_path)), options)
    # only records of unsaved slices were asked again
    assert len(os.listdir(tmp_path)) - first == 120 - kept
    rows = done.collect()
    assert len(rows) == len({r.conv_id for r in rows}) == 120
    assert {r.conversation[0]["value"] for r in rows} == {"I answer briefly"}
    # nothing is left to do
    R.resume_processing(df, path, make_counted(str(tmp_path), 0), options)
    assert len(os.listdir(tmp_path)) - first == 120 - kept


def test_failed_records_are_saved_as_they_were(spark):
    df, path = sized(spark, 30), new_folder(spark, "rewritten")

    def make():
        def generate(prompts):
            if any("question 7 " in p for p in prompts):
                raise ValueError("seven")
            return ["New System Prompt: I answer briefly" for _ in prompts]

        return generate

    done = R.resume_processing(df, path, make, RewriteOptions(slices=2)).collect()
    old = [r for r in done if r.conversation[0]["value"] == "old"]
    assert len(done) == 30 and [r.conversation[1]["value"].startswith("question 7 ") for r in old] == [True]
    failed = R.failed_records(spark, path, df.schema).collect()
    assert [(r.conv_id, r.error) for r in failed] == [(old[0].conv_id, "ValueError: seven")]
    assert R.resume_processing(df.where("false"), path, make, RewriteOptions()).count() == 0


def test_markers_are_created_once(spark):
    path = f"{new_folder(spark, 'log')}/a"
    create_marker(spark, path)
    with pytest.raises(FileExistsError):
        create_marker(spark, path)
    assert file_names(spark, path.rsplit("/", 1)[0]) == ["a"]
    assert file_names(spark, new_folder(spark, "none")) == []
