"""Structured Streaming: the file-stream load ledger."""

from flightmarts.streaming.ledger import incremental_load, lake_stream

__all__ = ["incremental_load", "lake_stream"]
