"""dialoom: curation of chat transcripts as Spark DataFrame jobs."""

from dialoom.config import (
    CurateOptions,
    FilterOptions,
    OutputOptions,
    PreprocessOptions,
    RewriteOptions,
)

__all__ = [
    "CurateOptions",
    "FilterOptions",
    "OutputOptions",
    "PreprocessOptions",
    "RewriteOptions",
]
