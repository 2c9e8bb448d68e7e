"""Elements of JSON arrays in text files, large files by many tasks.

Files are read as text cut at closing braces, so Spark splits them like lines of text.
Where a split begins inside the array is found in two steps: each split reports what it does
to the state "inside a string, depth of brackets" for either answer to the first question,
and these reports (one narrow row per split) are folded file by file.  With its state known,
a split cuts its text at the commas of the outermost array.  Only the first and last piece
of a split can belong to an element that goes on in another one; they are put together by
file and by the split in which the element began.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.session import stage_table

_CUT = "}"
# a string (the closing quote may be missing at the end of the text), or a structural sign
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*("?)|[\[\]{},]', re.S)
_REST_OF_STRING = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*("?)', re.S)
_STEP = {"[": 1, "{": 1, "]": -1, "}": -1, ",": 0}
_WHOLE, _LEAD, _TRAIL, _OUTSIDE = range(4)


def _signs(text: str, inside: bool) -> tuple[list[tuple[int, str]], bool]:
    """Brackets, braces and commas outside strings, and whether the text ends in a string."""
    begin, found = 0, []
    if inside:
        rest = _REST_OF_STRING.match(text)
        if not rest.group(1):
            return found, True
        begin, inside = rest.end(), False
    for token in _TOKEN.finditer(text, begin):
        sign = text[token.start()]
        if sign == '"':
            inside = not token.group(1)
        else:
            found.append((token.start(), sign))
    return found, inside


def _splits(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[dict, str, bool, bool]]:
    """Pieces in order: row of the split (first piece's columns), text, whether it is the
    first, whether it is the last piece of its split.  A split is read in one run."""
    held = split = None
    fresh = True
    for batch in batches:
        columns = [c for c in batch.columns if c != "value"]
        for value, *rest in zip(batch["value"], *(batch[c] for c in columns), strict=True):
            row = dict(zip(columns, rest, strict=True))
            if held is not None:
                same = (row["file_path"], row["block"]) == (split["file_path"], split["block"])
                yield split, held, fresh, not same
                fresh = not same
            held, split = value, row
    if held is not None:
        yield split, held, fresh, True


def _effects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each split does to the state: end inside a string, change of depth; for a start
    outside (0) and inside (1) of one."""
    for split, text, first, last in _splits(batches):
        if first:
            ends, depths = [False, True], [0, 0]
        for k in (0, 1):
            found, ends[k] = _signs(text + _CUT, ends[k])
            depths[k] += sum(_STEP[sign] for _, sign in found)
        if last:
            yield pd.DataFrame(
                {
                    "file_path": [split["file_path"]],
                    "block": [split["block"]],
                    "length": [split["length"]],
                    "end0": [ends[0]],
                    "end1": [ends[1]],
                    "depth0": [depths[0]],
                    "depth1": [depths[1]],
                }
            )


def _states(reports: pd.DataFrame) -> pd.DataFrame:
    """State at the start of each split of a file, and which split is its last."""
    reports = reports.sort_values("block")
    inside, depth, starts = False, 0, []
    for r in reports.itertuples(index=False):
        starts.append((inside, depth))
        depth += r.depth1 if inside else r.depth0
        inside = bool(r.end1 if inside else r.end0)
    return pd.DataFrame(
        {
            "file_path": reports["file_path"],
            "block": reports["block"],
            "length": reports["length"],
            "inside": [s[0] for s in starts],
            "depth": [s[1] for s in starts],
            "last": reports["block"] == reports["block"].max(),
        }
    )


class _Cutter:
    """Cuts the pieces of one split into elements."""

    def __init__(self, split: dict):
        self.inside, self.depth = bool(split["inside"]), int(split["depth"])
        self.parts: list[str] = []
        # until the first comma or bracket of the outermost array, text goes on from before
        self.continues = self.depth > 0

    def _take(self, kind: int, closed: bool = True) -> tuple[int, bool, str]:
        text = "".join(self.parts)
        self.parts = []
        if self.continues:
            kind, self.continues = _LEAD, False
        return kind, closed, text

    def cut(self, text: str) -> Iterator[tuple[int, bool, str]]:
        found, self.inside = _signs(text, self.inside)
        begin = 0
        for at, sign in found:
            before = self.depth
            self.depth += _STEP[sign]
            opens, closes = (before, self.depth) == (0, 1), (before, self.depth) == (1, 0)
            if opens or closes or (sign == "," and before == 1):
                self.parts.append(text[begin:at])
                begin = at + 1
                yield self._take(_OUTSIDE if opens else _WHOLE)
        self.parts.append(text[begin:])
        if self.depth <= 0:
            yield self._take(_OUTSIDE)

    def rest(self) -> tuple[int, bool, str]:
        return self._take(_TRAIL, closed=False)


def _elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``(file_path, file_name, block, kind, closed, value)`` of the elements of splits."""
    rows, size = [], 0
    names = ["file_path", "file_name", "block", "kind", "closed", "value"]
    for split, text, first, last in _splits(batches):
        if first:
            cutter = _Cutter(split)
        where = (split["file_path"], split["file_name"], split["block"])
        # what follows the last brace of a file ends without one
        found = list(cutter.cut(text if last and split["last"] else text + _CUT))
        if last and cutter.depth > 0:
            found.append(cutter.rest())
        for kind, closed, value in found:
            if kind in (_LEAD, _TRAIL) or value.strip():
                rows.append((*where, kind, closed, value))
                size += len(value)
        if size > 1 << 22:
            yield pd.DataFrame(rows, columns=names)
            rows, size = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=names)


def read_elements(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(value, file_name, whole)``: the elements of the arrays in ``files`` as JSON text.

    ``whole`` is false for what belongs to no array (text before its bracket or after its
    end) and for an element that its file does not finish: a broken tail costs the elements
    from the break on, not those before it.  Blank places between commas are left out.
    Files with nothing in them give no rows.

    One row goes to the driver's planner per split that is part of a file, so the states are
    broadcast: some 100 bytes per ``spark.sql.files.maxPartitionBytes`` of input.  Both
    passes have to see the same splits; if the number of cores changes in between, the run
    stops with an error (``spark.sql.files.minPartitionNum`` makes it independent of them).
    """
    pieces = (
        spark.read.option("lineSep", _CUT)
        .text(files)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_block_length").alias("length"),
            F.col("_metadata.file_size").alias("size"),
        )
    )
    split = "file_path string, block bigint, length bigint"
    # a file in one split starts outside of everything
    reports = (
        pieces.where("length < size")
        .select("value", "file_path", "block", "length")
        .mapInPandas(_effects, f"{split}, end0 boolean, end1 boolean, depth0 bigint, depth1 bigint")
    )
    states = stage_table(
        reports.groupBy("file_path").applyInPandas(
            _states, f"{split}, inside boolean, depth bigint, last boolean"
        ),
        "splits",
    )
    lost = F.raise_error(F.lit("splits changed between passes: set spark.sql.files.minPartitionNum"))
    known = (F.col("length") == F.col("size")) | F.col("last").isNotNull()
    placed = pieces.join(F.broadcast(states), ["file_path", "block", "length"], "left").select(
        "value",
        "file_path",
        "file_name",
        "block",
        F.coalesce("inside", F.lit(False)).alias("inside"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.when(known, F.coalesce("last", F.lit(True))).otherwise(lost.cast("boolean")).alias("last"),
    )
    elements = stage_table(
        placed.mapInPandas(
            _elements,
            "file_path string, file_name string, block bigint, kind int, closed boolean, value string",
        ),
        "elements",
    )
    # an element that goes on belongs to the last split before in which one began
    narrow = elements.where(F.col("kind").isin(_LEAD, _TRAIL)).select(
        "file_path", "block", "kind"
    )
    before = (
        Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    begun = (
        narrow.groupBy("file_path", "block")
        .agg(F.max(F.when(F.col("kind") == _TRAIL, F.col("block"))).alias("own"))
        .withColumn("earlier", F.last("own", ignorenulls=True).over(before))
        .select("file_path", "block", "earlier")
    )
    parts = elements.where(F.col("kind").isin(_LEAD, _TRAIL)).join(begun, ["file_path", "block"])
    begin = F.when(F.col("kind") == _TRAIL, F.col("block")).otherwise(F.col("earlier"))
    joined = (
        parts.groupBy("file_path", begin.alias("begin"))
        .agg(
            F.max("closed").alias("whole"),
            F.first("file_name").alias("file_name"),
            F.array_sort(F.collect_list(F.struct("block", "value"))).alias("parts"),
        )
        .select(F.array_join("parts.value", "").alias("value"), "file_name", "whole")
    )
    settled = elements.where(~F.col("kind").isin(_LEAD, _TRAIL)).select(
        "value", "file_name", (F.col("kind") == _WHOLE).alias("whole")
    )
    return settled.unionByName(joined.where("NOT whole OR trim(value) <> ''"))
