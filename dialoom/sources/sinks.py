"""Writing records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.config import OutputOptions
from dialoom.functions import messages as M


#: Part files have five digits, so more of them would not sort by name.
MAX_FILES = 99_999
#: Columns that place a record in its set and are no part of it.
PLACEMENT = ("position", "chunk", "segment", "split")


def drop_embedding_column(df: DataFrame) -> DataFrame:
    return df.drop("embedding", "qa_pair_embeddings")


def record_line(df: DataFrame) -> Column:
    """A record as one JSON object; the keys that the reader kept in ``extras`` stand
    beside the others, with the JSON text that they had."""
    plain = F.to_json(F.struct(*[c for c in df.columns if c != "extras"]))
    if "extras" not in df.columns:
        return plain

    def entry(e):
        key = F.to_json(F.array(e["key"]))
        return F.concat(F.substring(key, F.lit(2), F.length(key) - 2), F.lit(":"), e["value"])

    extras = F.transform(
        F.filter(F.map_entries("extras"), lambda e: e["value"].isNotNull()), entry
    )
    body = F.substring(plain, F.lit(1), F.length(plain) - 1)
    gap = F.when(plain == "{}", F.lit("")).otherwise(F.lit(","))
    joined = F.concat(body, gap, F.array_join(extras, ","), F.lit("}"))
    return F.when(F.coalesce(F.size(extras), F.lit(0)) > 0, joined).otherwise(plain)


def write_records_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Full records as JSON Lines, one text part file per task, non-ASCII kept."""
    df.select(record_line(df).alias("value")).write.mode(mode).text(path)


def write_conversations_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Only the message array of each record, one line per record."""
    df.select(M.conversation_line(F.col("conversation")).alias("value")).write.mode(
        mode
    ).text(path)


def write_ordered(
    df: DataFrame,
    line: Column,
    path: str,
    rows_per_file: int = 100_000,
    partition: str | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write ``line`` of each row so that file names, and the lines of a file, are in the
    order of the column ``position`` (numbers from 0, each once; gaps are allowed).

    Part file ``i`` holds the positions from ``i * rows_per_file`` on: a row's file is known
    from its position, so the rows are shuffled once, straight to their file, and sorted
    there.  With ``partition`` every value of that column gets its own folder, written in
    the same pass.  ``_manifest`` below ``path`` holds for each file its number, first and
    last position and number of lines; readers of the lines skip it.
    """
    keys = [partition] if partition else []
    number = F.floor(F.col("position") / F.lit(rows_per_file)).cast("int")
    last = df.agg(F.max("position").alias("last")).first().last
    n_files = 1 if last is None else last // rows_per_file + 1
    if n_files > MAX_FILES:
        raise ValueError(f"{n_files} files of {rows_per_file} rows: take more rows per file")
    placed = (
        df.select(*keys, "position", line.alias("value"))
        .repartitionById(n_files, number)
        .sortWithinPartitions(*keys, "position")
        .drop("position")
    )
    writer = placed.write.mode(mode)
    (writer.partitionBy(partition) if partition else writer).text(path)
    manifest = df.groupBy(*keys, number.alias("file")).agg(
        F.min("position").alias("first"),
        F.max("position").alias("last"),
        F.count(F.lit(1)).alias("lines"),
    )
    # one row per file
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")


def read_ordered(spark: SparkSession, path: str, partition: str | None = None) -> DataFrame:
    """``line_number, value`` (and the partition column) of a folder of ``write_ordered``:
    lines counted from 0 through the files in the order of their names."""
    keys = [partition] if partition else []
    kinds = "file int, first bigint, last bigint, lines bigint"
    manifest = spark.read.schema(
        f"{partition} string, {kinds}" if partition else kinds
    ).json(f"{path}/_manifest")
    before = Window.partitionBy(*keys).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = manifest.select(
        *keys, "file", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("_before")
    )
    name = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    lines = spark.read.text(path)
    if partition:
        # other sets below the folder have their own manifest
        lines = lines.withColumn(partition, F.col(partition).cast("string"))
    lines = lines.select(
        *keys,
        "value",
        name.alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),  # grows within a block
    )
    within = F.row_number().over(Window.partitionBy(*keys, "file").orderBy("_block", "_row")) - 1
    return (
        lines.withColumn("_within", within)
        .join(offsets, [*keys, "file"])
        .select(*keys, (F.col("_before") + F.col("_within")).alias("line_number"), "value")
    )


def write_splits(
    total: DataFrame,
    split: DataFrame,
    path: str,
    options: OutputOptions | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write train, test and total in each enabled format.

    ``split`` has a ``split`` column; train and test are written in one pass, as
    partitions ``split=train`` and ``split=test``.  If both tables have a ``position``, every
    set is written in its order (``write_ordered``); what places a record is left out of it.
    """
    options = options or OutputOptions()
    named = split.withColumn(
        "split",
        F.when(F.col("split") == "test", options.test_name).otherwise(options.train_name),
    )
    ordered = "position" in total.columns and "position" in split.columns
    formats = []
    if options.save_json:
        formats.append(("json", lambda df: record_line(df.drop(*PLACEMENT))))
    if options.save_jsonl:
        formats.append(("jsonl", lambda df: M.conversation_line(F.col("conversation"))))
    for kind, line in formats:
        folder = f"{path}/{kind}"
        whole = f"{folder}/split={options.total_name}"
        if ordered:
            write_ordered(named, line(named), folder, options.rows_per_file, "split", mode)
            write_ordered(total, line(total), whole, options.rows_per_file, None, mode)
        else:
            lines = named.select("split", line(named).alias("value"))
            lines.write.mode(mode).partitionBy("split").text(folder)
            total.select(line(total).alias("value")).write.mode(mode).text(whole)
