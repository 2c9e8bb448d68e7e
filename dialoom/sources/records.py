"""Reading conversation records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from dialoom.config import OutputOptions
from dialoom.operators.ranking import rank_in_groups
from dialoom.session import stage_table
from dialoom.sources.arrays import read_elements

_RAW_MESSAGES = t.ArrayType(t.MapType(t.StringType(), t.StringType()))
CONTAINERS = ("messages", "conversations", "conversation")


#: Keys with a column of their own.  ``nbytes`` is always computed anew.
_KNOWN = (*CONTAINERS, "source", "nbytes", "qa_pair_embeddings")


def normalize_container_key(df: DataFrame) -> DataFrame:
    """``messages``, else ``conversations``, else ``conversation`` → ``conversation``."""
    present = [c for c in CONTAINERS if c in df.columns]
    return df.withColumn("_container", F.coalesce(*present)).drop(*present).withColumnRenamed(
        "_container", "conversation"
    )


def exclude_sources(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Leave out files by name.  The name is file metadata: no other file is opened."""
    return df.where(~F.col("file_name").isin(*names)) if names else df


def output_names(options: OutputOptions) -> list[str]:
    stems = (options.test_name, options.train_name, options.total_name)
    return [f"{stem}.{kind}" for kind in ("jsonl", "json") for stem in stems]


def _parsed(lines: DataFrame) -> DataFrame:
    """``(value, file_name)`` → records ``(conversation, source, qa_pair_embeddings, extras,
    _corrupt_record, file_name)``.

    A record is read as a map first, so no key is lost: those without a column go to
    ``extras`` as their JSON text.  A side field that cannot be read is null and costs
    nothing else.
    """
    is_array = F.startswith(F.ltrim("value"), F.lit("["))
    fields = F.from_json(F.when(~is_array, F.col("value")), "map<string,variant>")
    bare = F.from_json(F.when(is_array, F.col("value")), _RAW_MESSAGES)
    as_text = lines.select(
        "file_name",
        "value",
        bare.alias("_bare"),
        F.transform_values(fields, lambda _, v: F.to_json(v)).alias("_fields"),
    )

    def text(name):
        return F.try_element_at("_fields", F.lit(name))

    lists = [F.from_json(text(c), _RAW_MESSAGES) for c in CONTAINERS]
    vector = F.from_json(text("qa_pair_embeddings"), "array<float>")
    whole = ~F.exists(vector, lambda x: x.isNull())
    # a string in JSON, or the text of anything else
    source = F.coalesce(
        F.get_json_object(F.concat(F.lit('{"s":'), text("source"), F.lit("}")), "$.s"),
        text("source"),
    )
    df = as_text.select(
        F.coalesce("_bare", *lists).alias("conversation"),
        F.when(text("source") != "null", source).alias("source"),
        F.when(whole, vector).alias("qa_pair_embeddings"),
        F.map_filter("_fields", lambda k, _: ~k.isin(*_KNOWN)).alias("extras"),
        "value",
        "file_name",
    )
    unread = F.when(F.col("conversation").isNull(), F.col("value"))
    return df.withColumn("_corrupt_record", unread).drop("value")


def _direct_files(
    spark: SparkSession, directory: str, pattern: str, exclude: Sequence[str]
) -> list[str]:
    """Paths of the files of a folder that match, without its subfolders: what an earlier
    run wrote below it is not read."""
    path = f"{directory.rstrip('/')}/{pattern}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    files = [s.getPath().toString() for s in found or [] if s.isFile()]
    names = set(exclude)
    return [f for f in files if f.rsplit("/", 1)[-1] not in names]


def read_json_array(
    spark: SparkSession, directory: str, pattern: str = "*.json", exclude: Sequence[str] = ()
) -> DataFrame:
    """Files that hold one JSON array of records each; not recursive.

    Large files are split (see ``arrays``).  An element that is no record, and what belongs
    to no whole element of an array, comes back with ``_corrupt_record``; the elements before
    it are read.
    """
    files = _direct_files(spark, directory, pattern, exclude)
    if not files:
        return _parsed(spark.createDataFrame([], "value string, file_name string"))
    elements = read_elements(spark, files)
    broken = elements.where("NOT whole")
    return _parsed(elements.where("whole").drop("whole")).unionByName(
        broken.select(F.col("value").alias("_corrupt_record"), "file_name"),
        allowMissingColumns=True,
    )


def read_jsonl(
    spark: SparkSession, directory: str, pattern: str = "*.jsonl", exclude: Sequence[str] = ()
) -> DataFrame:
    """Files with one JSON value per line: a record, or a bare message array; not recursive.

    A bad line comes back with ``_corrupt_record``; the lines after it are read.
    """
    files = _direct_files(spark, directory, pattern, exclude)
    if not files:
        return _parsed(spark.createDataFrame([], "value string, file_name string"))
    lines = spark.read.text(files).select("value", F.col("_metadata.file_name").alias("file_name"))
    return _parsed(lines.where(F.trim("value") != ""))


def combine_sources(*frames: DataFrame) -> DataFrame:
    """Bag union; duplicates are kept and missing columns are null."""
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined


def with_record_ids(df: DataFrame) -> DataFrame:
    """Add ``conv_id`` to records that come without one: the content's hash, and a number
    among equal contents.

    The number follows the hash of the whole row with its file name, so ids depend neither
    on the order of files nor on partitions; rows equal in everything are interchangeable.
    A content that many records share is numbered by many tasks.  The rows are written at
    once, so every later step sees the same ids.
    """
    row = F.md5(F.to_json(F.struct(*df.columns)))
    keyed = df.withColumn("_key", F.sha2(F.to_json("conversation"), 256)).withColumn("_row", row)
    numbered = rank_in_groups(keyed, "_key", F.col("_row"), ["_row"], "_number")
    name = F.concat("_key", F.lit("-"), F.lpad(F.hex("_number"), 16, "0"))
    return stage_table(
        numbered.withColumn("conv_id", name).drop("_key", "_row", "_number"), "records"
    )


def append_unmodified(df: DataFrame, unmodified: DataFrame) -> DataFrame:
    """Add records that were not cleaned, marked by ``unmodified``."""
    return df.withColumn("unmodified", F.lit(False)).unionByName(
        unmodified.withColumn("unmodified", F.lit(True)), allowMissingColumns=True
    )


def assemble_conversations(
    rows: DataFrame,
    by: str = "conv_id",
    order: str = "turn",
    fields: dict[str, str] | None = None,
) -> DataFrame:
    """Long rows, one per message → one record per conversation.

    ``fields`` maps message keys to columns; ``role`` and ``content`` by default.
    Messages become maps, like those read from JSON.
    """
    fields = fields or {"role": "role", "content": "text"}
    # maps cannot be sorted, so rows are collected as structs and turned into maps after
    columns = [F.col(c).cast("string").alias(f"f{i}") for i, c in enumerate(fields.values())]
    collected = F.collect_list(F.struct(F.col(order).alias("at"), *columns))
    sorted_rows = F.array_sort(collected)
    keys = list(fields)
    return rows.groupBy(by).agg(
        F.transform(
            sorted_rows,
            lambda r: F.create_map(
                *[x for i, key in enumerate(keys) for x in (F.lit(key), r[f"f{i}"])]
            ),
        ).alias("conversation")
    )
