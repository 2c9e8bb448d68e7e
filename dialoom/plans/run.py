"""A run from a folder of files to train, test and total sets below it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.config import CurateOptions
from dialoom.functions import messages as M
from dialoom.operators.clean import quarantine
from dialoom.operators.rewrite import Generator
from dialoom.plans.curate import Curated, curate
from dialoom.sources.records import (
    combine_sources,
    output_names,
    read_json_array,
    read_jsonl,
    with_record_ids,
)
from dialoom.sources.sinks import write_splits


def read_folder(spark: SparkSession, directory: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Array files and line files of a folder, without its subfolders."""
    return combine_sources(
        read_json_array(spark, directory, exclude=exclude),
        read_jsonl(spark, directory, exclude=exclude),
    )


def _named(df: DataFrame) -> DataFrame:
    good, _ = quarantine(df)
    return with_record_ids(good).drop("file_name", "_corrupt_record")


def run_directory(
    spark: SparkSession,
    directory: str,
    options: CurateOptions | None = None,
    unmodified: Sequence[str] = (),
    output: str | None = None,
    embed: Callable[[DataFrame], DataFrame] | None = None,
    make_generator: Callable[[], Generator] | None = None,
) -> Curated:
    """Read a folder, curate its records and write the sets to ``output``, by default the
    folder ``curated`` below it.

    Files with the names of own outputs are not read, nor are subfolders, so a second run
    over the same folder sees the same input and replaces the sets.  The files named in
    ``unmodified`` skip the cleaning and are appended before the final size cap.
    """
    options = options or CurateOptions()
    own = output_names(options.output)
    records = _named(read_folder(spark, directory, [*own, *unmodified]))
    kept = None
    if unmodified:
        every = read_folder(spark, directory, own)
        kept = _named(every.where(F.col("file_name").isin(*unmodified))).withColumn(
            "conversation",
            M.project_messages(M.map_roles(M.rename_message_keys(F.col("conversation")))),
        )
    done = curate(records, options, embed, make_generator, kept)
    path = output or f"{directory.rstrip('/')}/curated"
    write_splits(done.total, done.split, path, options.output, mode="overwrite")
    return done
