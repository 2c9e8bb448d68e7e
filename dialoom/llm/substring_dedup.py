"""Substring dedup: fixed-block anchors, rolling probes, maximal exact repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import narrow, words
from dialoom.llm.wordhash import WordChunk, word_chunks
from dialoom.session import stage_table

_BUCKET_BYTES = 8 << 20  # text per bucket
_ENTRIES_PER_BUCKET = 256  # held by a task before it sends a row to each bucket
_HOT = 256  # documents of one task with the same block, from which they are hits at once
_ROWS = "bucket int, part bigint, first bigint, width int, steps binary, values binary"
_SECOND = 0x5D1F


@dataclass(frozen=True)
class RepeatOptions:
    """A run of ``window`` words that also starts in an earlier document is removed.  An
    aligned block of ``block`` words lies in every window, wherever it starts."""

    window: int = 50

    @property
    def block(self) -> int:
        return (self.window + 1) // 2


def _bucket_bits(docs: DataFrame) -> int:
    """Bits of the bucket number: the text of a bucket has a fixed mean size."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(min(16, max(6, np.ceil(np.log2(max(1, total / _BUCKET_BYTES))))))


def _starts(chunk: WordChunk, d: int, n: int) -> tuple[int, int]:
    """First and one past the last start of a run of ``n`` words in text ``d``."""
    a, b = int(chunk.first[d]), int(chunk.first[d + 1])
    return a, max(a, b - n + 1)


class _Packer:
    """Collects ``(bucket, document, value)`` and yields a row per bucket: the documents as
    a first id and narrow steps, and the values packed.

    ``settle`` tells what the task knows already.  That goes to a part of its own, so the
    common part 0 of a bucket holds few rows of a value that very many documents share.
    """

    def __init__(self, bits: int, settle):
        self.bits, self.settle, self.parts, self.held = bits, settle, [], 0

    def add(self, doc: int, h: np.ndarray, values: np.ndarray) -> None:
        """``values`` is a two-dimensional array of bytes, one row per hash."""
        if len(h):
            bucket = (h >> np.uint64(64 - self.bits)).astype(np.uint16)
            self.parts.append((np.full(len(h), doc, np.int64), bucket, values))
            self.held += len(h)

    def full(self) -> bool:
        return self.held >= _ENTRIES_PER_BUCKET << self.bits

    def flush(self) -> Iterator[pd.DataFrame]:
        if not self.held:
            return
        doc, bucket, values = (np.concatenate(p) for p in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        sure, asked = self.settle(bucket, doc, values)
        rows = self._rows(bucket[asked], doc[asked], values[asked], 0)
        if sure.any():
            rows += self._rows(bucket[sure], doc[sure], values[sure], int(doc[0]) | 1)
        columns = ["bucket", "part", "first", "width", "steps", "values"]
        yield pd.DataFrame(rows, columns=columns, dtype=object)

    @staticmethod
    def _rows(bucket: np.ndarray, doc: np.ndarray, values: np.ndarray, part: int) -> list:
        order = np.argsort(bucket, kind="stable")
        doc, bucket, values = doc[order], bucket[order], values[order]
        begin, size = _groups((bucket,))
        steps = np.diff(doc, prepend=doc[:1])
        rows = []
        for a, n in zip(begin, size, strict=True):
            own = steps[a : a + n].copy()
            own[0] = 0
            most = np.abs(own).max()
            width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
            packed = own.astype(f"<i{width}").tobytes()
            rows.append(
                (int(bucket[a]), part, int(doc[a]), width, packed, values[a : a + n].tobytes())
            )
        return rows


def _unpack(rows: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    docs = np.concatenate(
        [
            first + np.cumsum(np.frombuffer(steps, f"<i{w}").astype(np.int64))
            for first, w, steps in zip(rows["first"], rows["width"], rows["steps"], strict=True)
        ]
    )
    values = np.frombuffer(b"".join(rows["values"]), np.uint8).reshape(-1, width)
    return docs, values


def _groups(keys: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Begins and sizes of the runs of equal keys in sorted arrays."""
    change = np.zeros(len(keys[0]), dtype=bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    begin = np.flatnonzero(change)
    return begin, np.diff(np.append(begin, len(change)))


def _block_values(values: np.ndarray) -> np.ndarray:
    wide = values.astype(np.int32)
    return wide[:, 0] | wide[:, 1] << 8 | wide[:, 2] << 16


def _settle_blocks(bucket, doc, values):
    """A block that many documents of a task hold is a hit in all of them, which is safe: a
    false hit changes nothing.  Only its first aligned and its last document are asked for,
    on behalf of the rest."""
    v = _block_values(values)
    key = bucket.astype(np.int64) << 23 | v >> 1
    order = np.argsort(key, kind="stable")
    begin, size = _groups((key[order],))
    sure, asked = np.zeros(len(v), bool), np.ones(len(v), bool)
    for a, n in zip(begin[size >= _HOT], size[size >= _HOT], strict=True):
        at = order[a : a + n]
        sure[at], asked[at] = True, False
        aligned = at[(v[at] & 1) > 0]
        if len(aligned):
            asked[aligned[doc[aligned].argmin()]] = True
        asked[at[doc[at].argmax()]] = True
    return sure, asked


def _window_values(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = np.ascontiguousarray(values[:, :8]).view(np.uint64)[:, 0]
    second = np.ascontiguousarray(values[:, 8:]).view(np.uint32)[:, 0]
    return h, second


def _settle_windows(bucket, doc, values):
    """Of the documents of a task with one window, all but the first are settled: an
    earlier one holds it.  Only the first is asked for."""
    h, second = _window_values(values)
    order = np.lexsort((doc, second, h))
    begin, size = _groups((h[order], second[order]))
    later = doc[order] > np.repeat(doc[order][begin], size)
    sure = np.zeros(len(h), bool)
    sure[order[later]] = True
    return sure, ~sure


def _probes(o: RepeatOptions, bits: int):
    """Every rolling block of every document with a window, and whether it is aligned in
    its document: the aligned ones are the index, the rolling ones the probes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = _Packer(bits, _settle_blocks)
        for batch in batches:
            ids = batch["doc_id"].to_numpy(np.int64)
            for chunk in word_chunks(batch["text"]):
                runs = chunk.runs(o.block)
                for d, row in enumerate(chunk.rows):
                    a, b = _starts(chunk, d, o.block)
                    if chunk.first[d + 1] - a < o.window:
                        continue
                    h = runs[a:b]
                    aligned = (np.arange(b - a) % o.block == 0).astype(np.uint64)
                    # 23 bits after those of the bucket, and the mark: three bytes
                    v = ((h << np.uint64(bits)) >> np.uint64(41)) << np.uint64(1) | aligned
                    packer.add(int(ids[row]), h, v.view(np.uint8).reshape(-1, 8)[:, :3])
                if packer.full():
                    yield from packer.flush()
        yield from packer.flush()

    return run


def _anchor_hits(rows: pd.DataFrame) -> pd.DataFrame:
    """Blocks of a bucket that are aligned in one document and occur in a later one, for
    the documents from the first of those on."""
    doc, raw = _unpack(rows, 3)
    v = _block_values(raw)
    order = np.argsort(v >> 1, kind="stable")
    h, doc, aligned = (v >> 1)[order], doc[order], (v & 1)[order] > 0
    begin, size = _groups((h,))
    first = np.minimum.reduceat(np.where(aligned, doc, np.iinfo(np.int64).max), begin)
    group_first = np.repeat(first, size)
    hit = (np.repeat(np.maximum.reduceat(doc, begin), size) > group_first) & (doc >= group_first)
    hit |= bool(rows["part"].iat[0])
    doc, h = doc[hit], h[hit]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    begin, _ = _groups((doc, h))
    doc, h = doc[begin], h[begin]
    ids, at = np.unique(doc, return_index=True)
    parts = np.split(h.astype(np.int32), at[1:]) if len(ids) else []
    blocks = pd.Series([p.tolist() for p in parts], dtype=object)
    return pd.DataFrame({"doc_id": ids, "bucket": rows["bucket"].iat[0], "blocks": blocks})


def _candidate_starts(chunk: WordChunk, d: int, runs: np.ndarray, hits: np.ndarray, o, bits: int):
    """Starts of the windows of text ``d`` that hold a hit block."""
    a, b = _starts(chunk, d, o.block)
    at = np.flatnonzero(np.isin(runs[a:b] >> np.uint64(41 - bits), hits))
    a, b = _starts(chunk, d, o.window)
    cover = np.zeros(b - a + o.window + 1, np.int64)
    reach = o.window - o.block
    np.add.at(cover, np.maximum(0, at - reach), 1)
    np.add.at(cover, np.minimum(b - a, at + 1), -1)
    return a, np.flatnonzero(np.cumsum(cover[: b - a]) > 0)


def _windows(o: RepeatOptions, bits: int):
    """Hit blocks extended word by word: the windows around them, by a hash of 96 bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = _Packer(bits, _settle_windows)
        for batch in batches:
            ids = batch["doc_id"].to_numpy(np.int64)
            for chunk in word_chunks(batch["text"]):
                runs = chunk.runs(o.block)
                one, two = chunk.runs(o.window), chunk.runs(o.window, _SECOND)
                for d, row in enumerate(chunk.rows):
                    hits = np.asarray(batch["hits"].iat[row], np.int64).astype(np.uint64)
                    a, starts = _candidate_starts(chunk, d, runs, hits, o, bits)
                    h = one[a + starts]
                    second = (two[a + starts] >> np.uint64(32)).astype(np.uint32)
                    values = np.concatenate(
                        (h.view(np.uint8).reshape(-1, 8), second.view(np.uint8).reshape(-1, 4)), axis=1
                    )
                    packer.add(int(ids[row]), h, values)
                if packer.full():
                    yield from packer.flush()
        yield from packer.flush()

    return run


def _repeated_windows(rows: pd.DataFrame) -> pd.DataFrame:
    """Windows of a bucket that also occur in a document with a smaller id."""
    doc, raw = _unpack(rows, 12)
    h, second = _window_values(raw)
    order = np.lexsort((doc, second, h))
    h, second, doc = h[order], second[order], doc[order]
    begin, size = _groups((h, second))
    later = doc > np.repeat(doc[begin], size)
    later |= bool(rows["part"].iat[0])
    doc, h = doc[later], h[later]
    order = np.argsort(doc, kind="stable")
    ids, at = np.unique(doc[order], return_index=True)
    parts = np.split(h[order], at[1:]) if len(ids) else []
    windows = pd.Series([p.tobytes() for p in parts], dtype=object)
    return pd.DataFrame({"doc_id": ids, "windows": windows})


def _removals(o: RepeatOptions):
    """Ranges of removed words, and the hash of what is left."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for chunk in word_chunks(batch["text"]):
                runs = chunk.runs(o.window)
                for d, row in enumerate(chunk.rows):
                    known = np.frombuffer(b"".join(batch["windows"].iat[row]), np.uint64)
                    a, b = _starts(chunk, d, o.window)
                    n = int(chunk.first[d + 1]) - a
                    at = np.flatnonzero(np.isin(runs[a:b], known))
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, np.minimum(n, at + o.window), -1)
                    gone = np.cumsum(edge[:n]) > 0
                    change = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
                    kept = [
                        chunk.data[s:e]
                        for s, e, g in zip(
                            chunk.start[a : a + n], chunk.end[a : a + n], gone, strict=True
                        )
                        if not g
                    ]
                    spans = [
                        {"first": int(x), "last": int(y) - 1}
                        for x, y in zip(change[0::2], change[1::2], strict=True)
                    ]
                    rows.append(
                        (
                            batch["doc_id"].iat[row],
                            batch["full_sha"].iat[row],
                            int(gone.sum()),
                            hashlib.sha256(b" ".join(kept)).hexdigest(),
                            spans,
                        )
                    )
            columns = ["r_id", "r_sha", "n_removed", "kept_sha256", "removed"]
            yield pd.DataFrame(rows, columns=columns, dtype=object)

    return run


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    options: RepeatOptions | None = None,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, removed`` of every row.

    ``removed`` are ranges of words (first and last, from 0) covered by windows whose words
    also start in a document with a smaller id, judged on the input.

    * The blocks at multiples of ``block`` words are the index, every rolling block is a
      probe.  Both go to the bucket of their hash, packed, four bytes a word; the number of
      buckets follows the size of the text, so a bucket has the same size at any scale.
    * A block that is aligned in one document and occurs in a later one is a hit.  Windows
      around hits are compared by 96 bits of two hashes: neighbouring windows that agree
      are the maximal exact repeat around the hit, so false hits change nothing.  A passage
      that a third of all documents hold is one group of hashes, never pairs.
    * Only texts with hits are written and read again.

    Ids are whole numbers.  Null and empty texts have no words; rows with a null id are
    compared with nothing; rows with equal ids are one document, which never removes words
    of itself.
    """
    o = options or RepeatOptions()
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    usable = rows.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    bits = _bucket_bits(usable)
    parts = max(1, 1 << max(0, bits - 2))
    hits = (
        usable.mapInPandas(_probes(o, bits), _ROWS)
        .repartition(parts, "bucket", "part")
        .groupBy("bucket", "part")
        .applyInPandas(_anchor_hits, "doc_id bigint, bucket int, blocks array<int>")
    )
    found = hits.select(
        "doc_id",
        F.transform(
            "blocks", lambda b: F.shiftleft(F.col("bucket").cast("long"), 23) + b.cast("long")
        ).alias("blocks"),
    )
    by_doc = stage_table(
        found.groupBy("doc_id").agg(F.flatten(F.collect_list("blocks")).alias("hits")), "hits"
    )
    texts = stage_table(usable.join(by_doc, "doc_id"), "hit-texts")
    repeated = (
        texts.mapInPandas(_windows(o, bits), _ROWS)
        .repartition(parts, "bucket", "part")
        .groupBy("bucket", "part")
        .applyInPandas(_repeated_windows, "doc_id bigint, windows binary")
        .groupBy("doc_id")
        .agg(F.collect_list("windows").alias("windows"))
    )
    full_sha = F.sha2(F.array_join(words(F.col("text")), " "), 256)
    span = "array<struct<first:int,last:int>>"
    removed = stage_table(
        texts.join(repeated, "doc_id")
        .select("doc_id", "text", "windows", full_sha.alias("full_sha"))
        .mapInPandas(
            _removals(o),
            f"r_id bigint, r_sha string, n_removed bigint, kept_sha256 string, removed {span}",
        )
        .dropDuplicates(["r_id", "r_sha"]),
        "removed",
    )
    whole = rows.select("doc_id", words(F.col("text")).alias("w")).select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.sha2(F.array_join("w", " "), 256).alias("full_sha"),
    )
    return whole.join(
        removed, (F.col("doc_id") == F.col("r_id")) & (F.col("full_sha") == F.col("r_sha")), "left"
    ).select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "full_sha").alias("kept_sha256"),
        F.coalesce("removed", F.array().cast(span)).alias("removed"),
    )


def without_repeats(text, removed):
    """Column of the text's words without the ``removed`` ranges, joined by one space."""
    return F.array_join(
        F.filter(
            words(text),
            lambda w, i: ~F.exists(removed, lambda s: (s["first"] <= i) & (i <= s["last"])),
        ),
        " ",
    )
