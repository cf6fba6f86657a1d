from lexisieve.streaming.ingest import (
    emitted_outcomes,
    latest_outcomes,
    latest_postings,
    latest_terms,
    merge_producers,
    read_log,
    read_merged,
    stream_changes,
    stream_index,
    stream_ingest,
    stream_merge,
    stream_outcomes,
)

__all__ = ["emitted_outcomes", "latest_outcomes", "latest_postings", "latest_terms", "merge_producers", "read_log", "read_merged", "stream_changes",
           "stream_index", "stream_ingest", "stream_merge", "stream_outcomes"]
