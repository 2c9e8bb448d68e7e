"""The row-local steps on files as they arrive."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as t

from dialoom.config import PreprocessOptions
from dialoom.operators.clean import clean, require_both_roles


def clean_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: t.StructType,
    options: PreprocessOptions | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Clean the Parquet files that came to ``source`` since the last call.

    Runs the steps of :func:`dialoom.operators.clean.clean` on a stream and appends to
    ``target``.  The checkpoint remembers finished files, so an interrupted run goes on
    where it stopped and no record is processed twice.  Duplicates are not removed:
    that needs all records.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = require_both_roles(clean(reader.parquet(source), options))
    query = (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

