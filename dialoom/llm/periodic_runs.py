"""Maximal periodic runs of words, found with a dictionary of basic factors.

A basic factor is a stretch of ``2 ** k`` words; equal factors of a text have one name.  A
run of period ``q`` repeats each of its factors of the largest power of two ``m <= q`` after
``q`` words, that is between ``m`` and ``2 * m`` words later.  The occurrences of a factor
there form an arithmetic progression, and only its ends can be the smallest period of a
run: an inner one would make the words between two breaks of the progression's own
difference repeat with that difference.  So the first and the last occurrence in that
range propose periods; each proposal is extended both ways, factor by factor.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import narrow

#: Texts are worked off together up to this many words; a longer text is alone.
_CHUNK_WORDS = 1 << 17


def split_words(text: str | None) -> list[bytes]:
    """Maximal stretches without ASCII white space, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _repeated(keys: np.ndarray, at: np.ndarray, size: int) -> np.ndarray | None:
    """Names of the factors at ``at``, equal for equal ``keys``; -1 for a factor that
    occurs once and elsewhere.  None if nothing repeats."""
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    often = count > 1
    if not often.any():
        return None
    renamed = np.where(often, np.cumsum(often) - 1, -1).astype(np.int32)
    names = np.full(size + 1, -1, dtype=np.int32)  # one past the end never matches
    names[at] = renamed[name]
    return names


def basic_factors(codes: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of length 1, 2, 4, ... at each position, up to the last length
    with a repeated factor.  Only positions whose halves both repeat are looked at."""
    size = len(codes)
    levels = []
    names = _repeated(codes, np.arange(size), size)
    while names is not None:
        levels.append(names)
        m = 1 << (len(levels) - 1)
        at = np.flatnonzero(names[: max(0, size - m)] >= 0)
        at = at[names[at + m] >= 0]
        if not len(at):
            break
        keys = names[at].astype(np.int64) * (int(names.max()) + 1) + names[at + m]
        names = _repeated(keys, at, size)
    return levels


def _proposals(names: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances to the first and the last occurrence of the same factor
    from ``m`` to ``2 * m - 1`` words later."""
    at = np.flatnonzero(names >= 0)
    order = np.argsort(names[at], kind="stable")
    at = at[order].astype(np.int64)
    span = len(names) + 2 * m
    key = names[at].astype(np.int64) * span + at
    low = np.searchsorted(key, key + m)
    high = np.searchsorted(key, key + 2 * m) - 1
    found = low <= high
    at, low, high = at[found], low[found], high[found]
    # key differences are distances, as both keys have one name
    start = key[found]
    first, last = key[low] - start, key[high] - start
    other = last != first
    return np.concatenate((at, at[other])), np.concatenate((first, last[other]))


def _extend(levels: list[np.ndarray], at: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words match the word ``q`` later, from ``at`` on and before ``at``."""
    right, left = np.zeros_like(at), np.zeros_like(at)
    for k in range(len(levels) - 1, -1, -1):
        names, m = levels[k], 1 << k
        here = names[at + right]
        right += m * ((here >= 0) & (here == names[at + right + q]))
        back = at - left - m
        here = np.where(back >= 0, names[np.maximum(back, 0)], -1)
        left += m * ((here >= 0) & (here == names[np.maximum(back, 0) + q]))
    return right, left


def find_runs(codes: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run, by start and period."""
    levels = basic_factors(codes)
    positions, periods = [], []
    for k, names in enumerate(levels):
        at, q = _proposals(names, 1 << k)
        if len(at):
            # a run proposes its period at neighbouring positions: one of them will do
            order = np.lexsort((at, q))
            at, q = at[order], q[order]
            same = (at[1:] == at[:-1] + 1) & (q[1:] == q[:-1])
            keep = np.concatenate(([True], ~same))
            positions.append(at[keep])
            periods.append(q[keep])
    if not positions:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    at, q = np.concatenate(positions), np.concatenate(periods)
    right, left = _extend(levels, at, q)
    start, end = at - left, at + right + q
    long = end - start >= np.maximum(min_length, 2 * q)
    start, end, q = start[long], end[long], q[long]
    # a multiple of the smallest period has the same run: the smallest comes first
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _chunks(texts: Sequence[str | None]) -> Iterator[tuple[list[list[bytes]], np.ndarray, np.ndarray]]:
    """Words of some texts, codes of all their words and the place of each first word.

    Codes are equal for equal words of one text only; between two texts is a code of its
    own, so no factor spans two texts.
    """
    held, codes, begins, size, code = [], [], [], 0, 0
    for text in texts:
        found = split_words(text)
        known: dict[bytes, int] = {}
        local = [known.setdefault(w, len(known)) for w in found]
        begins.append(size)
        codes.append(np.array([*local, len(known)], dtype=np.int64) + code)
        held.append(found)
        code += len(known) + 1
        size += len(found) + 1
        if size >= _CHUNK_WORDS:
            yield held, np.concatenate(codes), np.array(begins)
            held, codes, begins, size, code = [], [], [], 0, 0
    if held:
        yield held, np.concatenate(codes), np.array(begins)


def text_runs(texts: Sequence[str | None], min_length: int) -> Iterator[tuple]:
    """Per text: starts, lengths and periods of its runs, and the text left when each run
    keeps its first period only, words joined by one space."""
    for held, codes, begins in _chunks(texts):
        start, end, q = find_runs(codes, min_length)
        bounds = np.searchsorted(start, np.append(begins, len(codes)))
        for i, found in enumerate(held):
            own = slice(bounds[i], bounds[i + 1])
            s, e, p = start[own] - begins[i], end[own] - begins[i], q[own]
            if len(s):
                change = np.zeros(len(found) + 1, dtype=np.int64)
                np.add.at(change, s + p, 1)
                np.add.at(change, e, -1)
                left = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                found = [found[j] for j in left]
            yield s, e - s, p, b" ".join(found).decode("utf-8", "surrogatepass")


def runs_column(text: Column, min_length: int = 12) -> Column:
    """Struct ``runs`` (array of ``start, length, period``, by start, then period) and
    ``collapsed`` of a text column."""

    @F.pandas_udf(
        "starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string"
    )
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = list(text_runs(batch.tolist(), min_length))
            yield pd.DataFrame(rows, columns=["starts", "lengths", "periods", "collapsed"])

    return find(text)


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 12,
) -> DataFrame:
    """``doc_id, runs, collapsed`` of every row.

    Words are maximal stretches without ASCII white space, numbered from 0.  A run is a
    stretch of at least ``min_length`` words and two periods in which words a period apart
    are equal and which no neighbouring word extends; its period is the smallest.
    ``collapsed`` leaves out the words that a run holds after its first period.

    Each row is judged alone, so repeated rows give equal results.  A null text has no
    words; an empty table gives an empty result.  A text is held by one task with about
    eight bytes per word and power of two up to its longest repeated stretch.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    found = rows.select("doc_id", runs_column(F.col("text"), min_length).alias("f"))
    runs = F.transform(
        F.arrays_zip("f.starts", "f.lengths", "f.periods"),
        lambda r: F.struct(
            r["starts"].alias("start"), r["lengths"].alias("length"), r["periods"].alias("period")
        ),
    )
    return found.select("doc_id", runs.alias("runs"), F.col("f.collapsed").alias("collapsed"))


def longest_run(runs: Column) -> Column:
    """The longest run; of equal ones that with the smallest start, then period.  Null if
    there is none."""
    ranked = F.transform(
        runs,
        lambda r: F.struct(
            (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")
        ),
    )
    return F.array_min(ranked)


def run_lines(runs: Column) -> Column:
    """One line ``start,length,period`` per run."""
    lines = F.transform(
        runs,
        lambda r: F.concat(
            F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]),
            F.lit("\n"),
        ),
    )
    return F.array_join(lines, "")
