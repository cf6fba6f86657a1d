from lexisieve.sources.corpus import (
    binary_corpus,
    conversation_changes,
    document_corpus,
    page_corpus,
    read_table,
    table_corpus,
)
from lexisieve.sources.requests import benchmark_requests

__all__ = [
    "benchmark_requests",
    "binary_corpus",
    "conversation_changes",
    "document_corpus",
    "page_corpus",
    "read_table",
    "table_corpus",
]
