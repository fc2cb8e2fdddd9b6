"""Streaming ingest of text lines."""

from tillscope.streaming.growing import follow_lines
from tillscope.streaming.ingest import (
    LineSink,
    classify_lines,
    ingest_lines,
    read_line_stream,
    read_sink,
)
from tillscope.streaming.supervise import supervised_ingest

__all__ = [
    "LineSink",
    "classify_lines",
    "follow_lines",
    "ingest_lines",
    "read_line_stream",
    "read_sink",
    "supervised_ingest",
]
