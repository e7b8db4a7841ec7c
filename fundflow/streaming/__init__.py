"""Structured Streaming: incremental pickup of newly landed period files."""

from fundflow.streaming.ingest import ingest_new_period_files

__all__ = ["ingest_new_period_files"]
