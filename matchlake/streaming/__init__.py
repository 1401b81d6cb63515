"""Incremental ingest as a file stream."""

from matchlake.streaming.incremental import incremental_stream

__all__ = ["incremental_stream"]
