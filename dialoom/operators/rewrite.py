"""Model-assisted rewriting of system prompts: the data side."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from dialoom.config import RewriteOptions
from dialoom.fixed_values import DEFAULT_CURRENT_PROMPT, GENERATED_PROMPT_MARKER, GPT, HUMAN, SYSTEM
from dialoom.functions import messages as M
from dialoom.functions import text as T
from dialoom.functions.base import let
from dialoom.session import create_marker, file_names, stage_table

#: Prompts that a task asks at least before it judges the share of failed ones.
MIN_ASKED = 20
_ERROR = "generation_error"

# list of prompts -> raw model output per prompt, None for a failure
Generator = Callable[[Sequence[str]], Sequence[str | None]]


def prompt_size_gate(nbytes: Column, context_size: int) -> Column:
    """Only records of at most twice the context size, in bytes, are rewritten."""
    return nbytes <= 2 * context_size


def current_system_prompt(messages: Column) -> Column:
    first = F.get(messages, F.lit(0))
    return F.when(first["from"] == SYSTEM, first["value"]).otherwise(
        F.lit(DEFAULT_CURRENT_PROMPT)
    )


def build_rewrite_prompt(messages: Column, current: Column, instruction: str) -> Column:
    """Instruction, current system prompt and the labelled turns after message 0."""

    def label(m: Column) -> Column:
        return F.when(m["from"] == HUMAN, F.lit("User Prompt")).otherwise(F.lit("My Response"))

    turns = F.transform(
        F.filter(
            F.slice(messages, F.lit(2), F.size(messages)),
            lambda m: m["from"].isin(HUMAN, GPT),
        ),
        lambda m: F.concat(label(m), F.lit(": "), m["value"], F.lit("\n")),
    )
    return F.concat(
        F.lit(f"SYSTEM: {instruction}\nUSER: CONVERSATION: Current System Prompt: "),
        current,
        F.lit("\n"),
        F.array_join(turns, " "),
        F.lit(f"\n{GENERATED_PROMPT_MARKER}"),
    )


def _answers(
    generate: Generator, prompts: list[str], retries: int
) -> list[tuple[str | None, str | None]]:
    """Answer and error text of each prompt.  A batch that fails is halved until the prompts
    that fail are alone; those are tried again, then given up."""
    try:
        answers = list(generate(prompts))
        if len(answers) != len(prompts):
            raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
        return [(answer, None) for answer in answers]
    except Exception as error:  # noqa: BLE001 - whatever a model raises costs its prompt only
        if len(prompts) > 1:
            half = len(prompts) // 2
            return _answers(generate, prompts[:half], retries) + _answers(
                generate, prompts[half:], retries
            )
        if retries > 0:
            return _answers(generate, prompts, retries - 1)
        return [(None, f"{type(error).__name__}: {error}")]


def generate_text(
    prompts: DataFrame,
    make_generator: Callable[[], Generator],
    prompt: str = "prompt",
    output: str = "raw_output",
    batch_rows: int = 16,
    error: str | None = None,
    retries: int = 1,
    max_error_share: float = 1.0,
) -> DataFrame:
    """Run the model over the prompts in batches; it starts once per worker and task.

    Only the prompts travel to Python.  Rows without a prompt get no output.  A prompt that
    the model raises on gets no output either; the column named by ``error`` holds the text
    of its error, null for all others.  A task stops the run once more than
    ``max_error_share`` of at least ``MIN_ASKED`` prompts have failed: then the model is
    broken, not the prompts.
    """

    @F.pandas_udf("answer string, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        generate = make_generator()
        n_asked = n_failed = 0
        for asked in batches:
            done = pd.DataFrame(
                {"answer": [None] * len(asked), "error": [None] * len(asked)}, dtype=object
            )
            wanted = np.flatnonzero(asked.notna())
            for start in range(0, len(wanted), batch_rows):
                rows = wanted[start : start + batch_rows]
                found = _answers(generate, asked.iloc[rows].tolist(), retries)
                done.iloc[rows, 0] = [answer for answer, _ in found]
                done.iloc[rows, 1] = errors = [text for _, text in found]
                n_asked += len(rows)
                failed = [text for text in errors if text is not None]
                n_failed += len(failed)
                if failed and n_asked >= MIN_ASKED and n_failed > max_error_share * n_asked:
                    raise RuntimeError(f"{n_failed} of {n_asked} prompts failed, last: {failed[-1]}")
            yield done

    # not to be run twice for one row
    answered = prompts.withColumn("_answered", run.asNondeterministic()(F.col(prompt)))
    answered = answered.withColumn(output, F.col("_answered.answer"))
    if error is not None:
        answered = answered.withColumn(error, F.col("_answered.error"))
    return answered.drop("_answered")


def two_pass_generate(
    df: DataFrame,
    make_generator: Callable[[], Generator],
    options: RewriteOptions,
    error: str | None = None,
) -> DataFrame:
    """Add ``generated``: the cleaned prompt after one pass, or after a second one that
    starts from the first result.  A failed pass leaves null, and the text of its error in
    the column named by ``error``."""
    m = F.col("conversation")
    fits = prompt_size_gate(F.col("nbytes"), options.context_size)

    def one_pass(rows: DataFrame, current: Column) -> DataFrame:
        asked = rows.withColumn(
            "prompt", F.when(fits, build_rewrite_prompt(m, current, options.instruction))
        )
        answered = generate_text(
            asked,
            make_generator,
            error="_error",
            retries=options.retries,
            max_error_share=options.max_error_share,
        )
        return answered.withColumn(
            "generated",
            T.clean_generated_prompt(T.strip_ansi(F.col("raw_output")), options.stop_markers),
        ).drop("prompt", "raw_output")

    df = one_pass(df, current_system_prompt(m))
    if options.twice:
        previous = df.withColumnRenamed("generated", "_previous").withColumnRenamed(
            "_error", "_previous_error"
        )
        # a null first result gives a null prompt, so the second pass skips the record
        df = (
            one_pass(previous, F.col("_previous"))
            .withColumn("_error", F.coalesce("_previous_error", "_error"))
            .drop("_previous", "_previous_error")
        )
    return df.drop("_error") if error is None else df.withColumnRenamed("_error", error)


def accept_rewrite(messages: Column, generated: Column, min_characters: int = 10) -> Column:
    """Replace the text of a leading system message by a result that is long enough."""
    return let(
        messages,
        lambda m: F.when(
            F.coalesce(
                (F.length(generated) > min_characters)
                & (F.get(m, F.lit(0))["from"] == SYSTEM),
                F.lit(False),
            ),
            F.concat(
                F.array(M.message(F.lit(SYSTEM), generated)),
                F.slice(m, F.lit(2), F.size(m)),
            ),
        ).otherwise(m),
    )


def improve_system_prompts(
    df: DataFrame,
    make_generator: Callable[[], Generator],
    options: RewriteOptions,
    error: str | None = None,
) -> DataFrame:
    """Replace system prompts by generated ones; a record whose prompt fails stays."""
    rewritten = two_pass_generate(df, make_generator, options, error)
    return rewritten.withColumn(
        "conversation",
        accept_rewrite(F.col("conversation"), F.col("generated"), options.min_characters),
    ).drop("generated")


def unprocessed(df: DataFrame, done: DataFrame) -> DataFrame:
    """Records whose id is not in the table of finished ones."""
    return df.join(done.select("conv_id"), "conv_id", "left_anti")


class SliceLog:
    """Finished slices of a run below ``path``.

    A slice is written to a folder of its own and counts once a marker with the folder's
    name lies in ``_log``.  Folders without marker, left by a run that died, are not read.
    One run at a time writes to a path.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def folders(self) -> list[str]:
        names = file_names(self.spark, f"{self.path}/_log")
        return [f"{self.path}/data/{name}" for name in names if name.startswith("slice-")]

    def read(self, schema: t.StructType) -> DataFrame:
        """Rows of all finished slices."""
        folders = self.folders()
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def new_slice(self, number: int) -> str:
        return f"slice-{number:05d}-{uuid.uuid4().hex}"

    def folder(self, name: str) -> str:
        return f"{self.path}/data/{name}"

    def commit(self, name: str) -> None:
        create_marker(self.spark, f"{self.path}/_log/{name}")


def resume_processing(
    df: DataFrame,
    path: str,
    make_generator: Callable[[], Generator],
    options: RewriteOptions,
    max_slices: int | None = None,
) -> DataFrame:
    """Rewrite what the finished slices at ``path`` do not hold yet, and return their rows
    for the records of ``df``.

    Records are cut by a hash of their id into ``options.slices`` slices, which are run and
    saved one after the other: a run that stops loses the slice it is in.  The records still
    to do are written once in the order of the slices, so that each slice reads its own
    files.  A record whose prompt fails is saved as it was; ``failed_records`` lists them.
    A slice with more than ``options.max_error_share`` failed records is not saved and stops
    the run.  ``max_slices`` ends a run after so many slices: the rows returned are then those
    that are done.
    """
    spark = df.sparkSession
    log = SliceLog(spark, path)
    kept = t.StructType([*df.schema.fields, t.StructField(_ERROR, t.StringType())])
    number = F.pmod(F.xxhash64("conv_id"), F.lit(options.slices)).cast("int")
    missing = unprocessed(df, log.read(kept)).withColumn("_slice", number)
    pending = stage_table(
        missing.repartitionByRange("_slice", "conv_id").sortWithinPartitions("_slice", "conv_id"),
        "pending",
    )
    sizes = {r["_slice"]: r["count"] for r in pending.groupBy("_slice").count().collect()}
    for part in sorted(sizes)[:max_slices]:
        rows = pending.where(F.col("_slice") == part).drop("_slice")
        name = log.new_slice(part)
        improve_system_prompts(rows, make_generator, options, _ERROR).select(
            *kept.names
        ).write.parquet(log.folder(name))
        written = spark.read.schema(kept).parquet(log.folder(name))
        n_failed = written.where(F.col(_ERROR).isNotNull()).count()
        if n_failed > options.max_error_share * sizes[part]:
            raise RuntimeError(f"slice {part}: {n_failed} of {sizes[part]} records failed")
        log.commit(name)
    return log.read(kept).drop(_ERROR).join(df.select("conv_id"), "conv_id", "left_semi")


def failed_records(spark: SparkSession, path: str, schema: t.StructType) -> DataFrame:
    """``conv_id, error`` of the records in the finished slices whose prompt failed."""
    kept = t.StructType([schema["conv_id"], t.StructField(_ERROR, t.StringType())])
    rows = SliceLog(spark, path).read(kept)
    return rows.where(F.col(_ERROR).isNotNull()).withColumnRenamed(_ERROR, "error")
