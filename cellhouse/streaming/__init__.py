"""Structured Streaming counterparts."""

from .stateful import live_visible, map_windows
from .stream import (live_latest, lookup_results, stream_lookup, stream_lookup_files, stream_lookup_static, stream_put,
                     windowed_groups)

__all__ = ["stream_put", "stream_lookup", "stream_lookup_files", "lookup_results", "stream_lookup_static",
           "windowed_groups", "map_windows", "live_latest", "live_visible"]
