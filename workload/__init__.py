"""Registered queries over the given tables, one per operator."""

from __future__ import annotations

import importlib

_MODULES = (
    "message_queries",
    "text_queries",
    "document_queries",
    "vector_queries",
    "size_queries",
    "source_queries",
    "rewrite_queries",
    "pipeline_queries",
)


def load_all() -> None:
    for name in _MODULES:
        importlib.import_module(f"workload.{name}")
