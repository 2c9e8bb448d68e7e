"""Cleaning, sizing, duplicate removal and the final role check."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dialoom.config import PreprocessOptions
from dialoom.operators.clean import clean, require_both_roles
from dialoom.operators.duplicates import drop_exact_duplicates
from dialoom.session import stage_table


def preprocess(df: DataFrame, options: PreprocessOptions | None = None) -> DataFrame:
    """Raw records (``conv_id``, ``conversation`` of maps) → clean records with
    ``nbytes``.

    ``nbytes`` is the size before rejected messages are dropped.  Records carry no
    order of their own: order means ``(nbytes, conv_id)``.  The cleaned rows are
    written before duplicates are removed, because they are read twice there.
    """
    options = options or PreprocessOptions()
    cleaned = clean(df, options)
    if options.drop_duplicates:
        cleaned = drop_exact_duplicates(stage_table(cleaned, "cleaned"))
    return require_both_roles(cleaned)
