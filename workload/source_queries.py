"""Readers and writers.  Files are written by Spark from the given tables into the
shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.config import OutputOptions
from dialoom.functions import messages as M
from dialoom.operators import split as S
from dialoom.operators.clean import cap_size, quarantine, with_nbytes
from dialoom.session import new_folder, stage_table
from dialoom.sources import records as R
from dialoom.sources import sinks as K
from workload import common as W
from workload.registry import Tables, query
from workload.size_queries import (
    NBINS,
    _curriculum,
    sql_balance,
    sql_segments,
    sql_size_bins,
    sql_split,
)

_ID = "id"  # the id of a conversation travels through files in a key of its own


def _records(t: Tables) -> DataFrame:
    """Raw records, each under one of the three names of its message list."""
    kind = F.col("conv_id") % 3
    c = F.col("conversation")
    return W.raw(t).select(
        F.when(kind == 0, c).alias("conversation"),
        F.when(kind == 1, c).alias("conversations"),
        F.when(kind == 2, c).alias("messages"),
        F.concat(F.lit("s"), kind).alias("source"),
        F.col("conv_id").alias(_ID),
    )


def _write_arrays(df: DataFrame, path: str) -> None:
    """JSON array files of about a hundred records each."""
    (
        df.withColumn("record", F.struct(*df.columns))
        .groupBy(F.floor(F.col(_ID) / 100).alias("file"))
        .agg(F.to_json(F.collect_list("record")).alias("value"))
        .select("value")
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )


def _long(df: DataFrame) -> DataFrame:
    """Readable records as one row per message."""
    good, _ = quarantine(df)
    return W.rows(W.with_roles(good.withColumn("conv_id", _id(df))))


def _id(df: DataFrame):
    """The id, also of a record that was read: unknown keys stay in ``extras``."""
    return (F.col("extras")[_ID] if "extras" in df.columns else F.col(_ID)).cast("bigint")


@query("read_json_array", f"WITH {W.SQL_MSGS} {W.LONG} FROM msgs")
def read_json_array(t):
    path = new_folder(t.spark, "arrays")
    _write_arrays(_records(t), path)
    return _long(R.read_json_array(t.spark, path, "*.txt"))


@query("read_jsonl", f"WITH {W.SQL_MSGS} {W.LONG} FROM msgs")
def read_jsonl(t):
    """With a broken line after each record; the broken ones go to quarantine."""
    path = new_folder(t.spark, "lines")
    df = _records(t)
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    broken = lines.select(F.substring("value", F.lit(1), F.length("value") - 2).alias("value"))
    lines.unionByName(broken).write.text(path)
    return _long(R.read_jsonl(t.spark, path, "*.txt"))


@query(
    "read_jsonl_quarantine",
    "SELECT count(DISTINCT conv_id) AS good, count(DISTINCT conv_id) AS bad FROM conversations",
)
def read_quarantine(t):
    path = new_folder(t.spark, "lines")
    df = _records(t)
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    broken = lines.select(F.substring("value", F.lit(1), F.length("value") - 2).alias("value"))
    lines.unionByName(broken).write.text(path)
    good, bad = quarantine(R.read_jsonl(t.spark, path, "*.txt"))
    marked = good.select(F.lit(1).alias("g")).unionByName(bad.select(F.lit(0).alias("g")))
    return marked.agg(
        F.count_if(F.col("g") == 1).alias("good"), F.count_if(F.col("g") == 0).alias("bad")
    )


@query("normalize_container_key", f"WITH {W.SQL_MSGS} {W.LONG} FROM msgs")
def container_key(t):
    return _long(R.normalize_container_key(_records(t)))


@query(
    "exclude_sources",
    f"WITH {W.SQL_MSGS} {W.LONG} FROM msgs WHERE conv_id % 3 <> 0",
)
def exclude_sources(t):
    """The files that hold source s0 are left out by name."""
    path = new_folder(t.spark, "named")
    lines = _records(t).select("source", F.to_json(F.struct(*_records(t).columns)).alias("value"))
    lines.where("source = 's0'").select("value").write.text(path)
    own = t.spark.read.text(path).select(F.col("_metadata.file_name").alias("n")).distinct()
    names = [r.n for r in own.collect()]
    lines.where("source <> 's0'").select("value").write.mode("append").text(path)
    return _long(R.read_jsonl(t.spark, path, "*.txt", exclude=names))


@query(
    "combine_sources",
    """SELECT conv_id, count(*) AS copies FROM (
      SELECT DISTINCT conv_id FROM conversations UNION ALL
      SELECT DISTINCT conv_id FROM conversations) GROUP BY conv_id""",
)
def combine_sources(t):
    """Once from array files, once from line files; both stay."""
    arrays, lines = new_folder(t.spark, "arrays"), new_folder(t.spark, "lines")
    df = _records(t)
    _write_arrays(df, arrays)
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(lines)
    both = R.combine_sources(
        R.read_json_array(t.spark, arrays, "*.txt"), R.read_jsonl(t.spark, lines, "*.txt")
    )
    return both.groupBy(_id(both).alias("conv_id")).agg(F.count(F.lit(1)).alias("copies"))


@query(
    "append_unmodified",
    f"""WITH {W.SQL_MSGS}, s AS (
      SELECT conv_id, CAST(coalesce(sum({W.SQL_NBYTES}) FILTER (role <> 'system'), 0) AS BIGINT)
        AS nbytes FROM msgs GROUP BY conv_id)
    SELECT conv_id, nbytes, 0 AS unmodified FROM s WHERE nbytes <= 3000
    UNION ALL SELECT conv_id + 1000000, nbytes, 1 FROM s WHERE nbytes <= 3000""",
)
def append_unmodified(t):
    """The same records again as a file that is not cleaned; the size cap still holds."""
    df = with_nbytes(W.with_roles(W.raw(t)))
    other = df.withColumn("conv_id", F.col("conv_id") + 1_000_000).drop("nbytes")
    both = cap_size(with_nbytes(R.append_unmodified(df.drop("nbytes"), other)), 3000)
    return both.select("conv_id", "nbytes", F.col("unmodified").cast("int").alias("unmodified"))


@query(
    "with_record_ids",
    """WITH c AS (
      SELECT conv_id, sha256('[' || string_agg('{"role":' || to_json(role)::VARCHAR || ',"content":'
        || to_json(text)::VARCHAR || '}', ',' ORDER BY turn) || ']') AS key
      FROM conversations GROUP BY conv_id), twice AS (SELECT * FROM c UNION ALL SELECT * FROM c)
    SELECT key || '-' || lpad(hex(row_number() OVER (PARTITION BY key)), 16, '0') AS conv_id
    FROM twice""",
)
def record_ids(t):
    """Every record twice: the hash of the content and a number."""
    df = W.raw(t).drop("conv_id")
    return R.with_record_ids(df.unionByName(df).repartition(5)).select("conv_id")


@query("write_records_json", f"WITH {W.SQL_MSGS} {W.LONG} FROM msgs")
def write_records(t):
    path = new_folder(t.spark, "json")
    df = W.with_roles(W.raw(t)).withColumn(_ID, F.col("conv_id")).drop("conv_id")
    K.write_records_json(df, path)
    return _long(R.read_jsonl(t.spark, path, "*.txt"))


@query(
    "unknown_keys_survive",
    """SELECT DISTINCT conv_id, '{"a":[1,2],"b":"é"}' AS topic, 1.5::DOUBLE AS weight,
      conv_id % 3 <> 2 AS good FROM conversations""",
)
def unknown_keys(t):
    """Extra keys are read, written and read again; a bad side field costs nothing, a null
    text costs the record."""
    first, second = new_folder(t.spark, "lines"), new_folder(t.spark, "json")
    records = F.to_json(F.struct(*_records(t).columns))
    text = F.regexp_replace(
        F.concat(
            F.lit('{"topic":{"a":[1,2],"b":"é"},"weight":1.5,"nbytes":"12x","qa_pair_embeddings":"no",'),
            F.substring(records, F.lit(2), F.length(records) - 1),
        ),
        r'"messages":\[\{"role":"[a-z]+"',
        '"messages":[{"role":null',
    )
    _records(t).select(text.alias("value")).write.text(first)
    K.write_records_json(R.read_jsonl(t.spark, first, "*.txt").drop("_corrupt_record"), second)
    again = R.read_jsonl(t.spark, second, "*.txt")
    good, bad = quarantine(again)
    marked = good.withColumn("good", F.lit(True)).unionByName(bad.withColumn("good", F.lit(False)))
    return marked.select(
        _id(marked).alias("conv_id"),
        F.col("extras")["topic"].alias("topic"),
        F.col("extras")["weight"].cast("double").alias("weight"),
        "good",
    )


SQL_LINE = """'[' || string_agg('{"from": ' || to_json(role)::VARCHAR || ', "value": '
  || to_json(value)::VARCHAR || '}', ', ' ORDER BY pos) || ']'"""


@query(
    "write_conversations_jsonl",
    f"WITH {W.SQL_MSGS} SELECT {SQL_LINE} AS line FROM msgs GROUP BY conv_id",
)
def write_conversations(t):
    path = new_folder(t.spark, "jsonl")
    K.write_conversations_jsonl(W.with_roles(W.raw(t)), path)
    return t.spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "read_back_conversations_jsonl",
    f"""WITH {W.SQL_MSGS} SELECT count(DISTINCT conv_id) AS conversations,
      count(*) AS messages, CAST(sum(length(value)) AS BIGINT) AS characters FROM msgs""",
)
def read_back(t):
    """Lines that hold bare message arrays are records too."""
    path = new_folder(t.spark, "jsonl")
    K.write_conversations_jsonl(W.with_roles(W.raw(t)), path)
    good, _ = quarantine(R.read_jsonl(t.spark, path, "*.txt"))
    m = M.rename_message_keys(F.col("conversation"))
    return good.select(F.transform(m, lambda x: F.length(x["value"])).alias("n")).agg(
        F.count(F.lit(1)).alias("conversations"),
        F.sum(F.size("n")).alias("messages"),
        F.sum(F.aggregate("n", F.lit(0), lambda a, x: a + x)).cast("bigint").alias("characters"),
    )


@query(
    "write_splits",
    f"""WITH {sql_size_bins(True)}, s AS ({sql_split('bins', 'size_bin')}), n AS (
      SELECT split, count(*) AS cnt FROM s GROUP BY split
      UNION ALL SELECT 'total', count(*) FROM recs)
    SELECT kind, split, cnt FROM n, (SELECT unnest(['json', 'jsonl']) AS kind)""",
)
def write_splits(t):
    path = new_folder(t.spark, "splits")
    df = with_nbytes(W.with_roles(W.raw(t)))
    placed = S.split_by_size_bin(df.select("conv_id", "nbytes"), NBINS, 0.2, W.SEED)
    split = df.join(placed.select("conv_id", "split"), "conv_id")
    K.write_splits(df, split, path, OutputOptions())
    counted = [
        t.spark.read.text(f"{path}/{kind}")
        .groupBy("split")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.lit(kind).alias("kind"), "split", "cnt")
        for kind in ("json", "jsonl")
    ]
    return counted[0].unionByName(counted[1])


@query(
    "ordered_splits",
    f"""WITH RECURSIVE {sql_balance(NBINS, True)}, {sql_segments(NBINS)},
    s AS ({sql_split('segs', 'segment')}),
    lines AS (SELECT conv_id, {SQL_LINE} AS line FROM msgs GROUP BY conv_id),
    p AS (
      SELECT c.conv_id, c.position, s.split, l.line
      FROM curriculum c JOIN s USING (conv_id) JOIN lines l USING (conv_id)),
    sets AS (SELECT * FROM p UNION ALL SELECT conv_id, position, 'total', line FROM p)
    SELECT kind, split, row_number() OVER (PARTITION BY kind, split ORDER BY position) - 1
      AS line_number, CASE kind WHEN 'jsonl' THEN line ELSE conv_id::VARCHAR END AS content
    FROM sets, (SELECT unnest(['json', 'jsonl']) AS kind)""",
)
def ordered_splits(t):
    """The curriculum through files of 16 positions each: content by line of the files."""
    path = new_folder(t.spark, "ordered")
    df = with_nbytes(W.with_roles(W.raw(t)))
    placed = S.split_by_segment(_curriculum(t), NBINS, 0.2, W.SEED)
    place = stage_table(placed.select("conv_id", "position", "chunk", "segment", "split"), "place")
    total = df.join(place, "conv_id")
    K.write_splits(total, total, path, OutputOptions(rows_per_file=16))
    found = []
    for kind in ("json", "jsonl"):
        parts = K.read_ordered(t.spark, f"{path}/{kind}", "split")
        whole = K.read_ordered(t.spark, f"{path}/{kind}/split=total")
        lines = parts.unionByName(whole.withColumn("split", F.lit("total")))
        content = F.get_json_object("value", "$.conv_id") if kind == "json" else F.col("value")
        found.append(
            lines.select(F.lit(kind).alias("kind"), "split", "line_number", content.alias("content"))
        )
    return found[0].unionByName(found[1])


@query(
    "drop_embedding_column",
    "SELECT vec_id AS conv_id, label FROM embeddings",
)
def drop_embedding(t):
    return K.drop_embedding_column(t("embeddings").withColumnRenamed("vec_id", "conv_id"))
