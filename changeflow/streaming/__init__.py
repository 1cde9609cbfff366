"""Structured Streaming: windowed metrics, sinks, current-state upkeep, runners."""

from changeflow.streaming.windows import tumbling_metrics, sliding_metrics, session_metrics
from changeflow.streaming.runner import (
    BoundedConsumer, consume_bounded, run_available, start_query,
)
from changeflow.streaming.progress import ProgressLog, observe_events, progress_frame, stream_metrics, timed_reports
from changeflow.streaming.state import (
    CurrentStateWriter, compact_state_changelog, maintain_state, read_current_state, read_state, read_state_changelog,
    state_updates,
)
from changeflow.streaming.facts import DayTable, DayTableSink
from changeflow.streaming.late import LateSplitter
from changeflow.streaming.sinks import BatchSink, IdempotentParquetAppend, SplitWriter

__all__ = ["BoundedConsumer", "consume_bounded", "tumbling_metrics", "sliding_metrics", "session_metrics", "run_available", "start_query",
           "progress_frame", "ProgressLog", "observe_events", "stream_metrics", "timed_reports", "BatchSink", "DayTable", "DayTableSink", "LateSplitter", "compact_state_changelog", "CurrentStateWriter", "read_current_state", "read_state", "maintain_state", "read_state_changelog", "state_updates", "IdempotentParquetAppend", "SplitWriter"]
