"""Structured Streaming forms of the feeds."""

from .streams import append_unseen_stream, first_seen_stream, json_tail, run_to_parquet, tail_with_quarantine  # noqa: F401
