"""Run logs as streams."""

from fitledger.streaming.lines import line_sink, read_line_counts, read_line_stream, read_lines
from fitledger.streaming.logs import read_log_stream, stream_checkpoint_events, stream_metrics
from fitledger.streaming.run_clock import stream_run_times
from fitledger.streaming.sinks import (
    drain, read_sink, step_time_sink, stream_time_per_step, table_sink, tee_sink, through,
)
from fitledger.streaming.uploads import follow_uploads

__all__ = [
    "drain", "follow_uploads", "line_sink", "read_line_counts", "read_line_stream", "read_lines", "read_log_stream",
    "read_sink", "step_time_sink", "stream_checkpoint_events", "stream_metrics", "stream_run_times", "stream_time_per_step", "table_sink",
    "tee_sink", "through",
]
