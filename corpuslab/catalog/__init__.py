"""Named queries over the given tables and their reference SQL."""

from . import (  # noqa: F401
    audit_queries,
    corpus_queries,
    cue_queries,
    publication_queries,
    stream_queries,
    text_queries,
    url_queries,
)
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
