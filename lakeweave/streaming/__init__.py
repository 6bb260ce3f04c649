"""Incremental processing of newly landed files (Structured Streaming)."""

from lakeweave.streaming.incremental import incremental_partition_refresh

__all__ = ["incremental_partition_refresh"]
