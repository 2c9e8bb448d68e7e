"""Retrieval documents: term counts, length and id of a conversation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom.functions.base import run_lengths, let, words


def document_tokens(system: Column, question: Column, answer: Column) -> Column:
    return words(F.concat_ws(" ", system, question, answer))


def term_frequencies(tokens: Column) -> Column:
    """Token → count, in token order, without leaving the row: sort, then count runs."""
    return let(
        F.array_sort(tokens),
        lambda t: F.map_from_entries(
            F.transform(
                run_lengths(t, lambda a, b: a == b),
                lambda run: F.struct(F.get(t, run["start"]), run["length"]),
            )
        ),
    )


def document_id(document: Column) -> Column:
    """SHA-256 of the document as JSON; its term map is in token order, so the id is
    the same in every run."""
    return F.sha2(F.to_json(document), 256)
