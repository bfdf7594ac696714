"""Incremental processing: high-water-mark reads and availableNow streams."""

from .incremental import current_mark, incremental_append, read_since, stream_new_files

__all__ = ["current_mark", "incremental_append", "read_since", "stream_new_files"]
