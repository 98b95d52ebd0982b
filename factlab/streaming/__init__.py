"""Event-time windows and sessions of file streams, run to the end of what has arrived."""

from factlab.streaming.runs import Progress, file_stream, run_available
from factlab.streaming.windows import stream_sessions, stream_windows

__all__ = ["Progress", "file_stream", "run_available", "stream_sessions", "stream_windows"]
