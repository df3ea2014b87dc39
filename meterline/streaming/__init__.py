"""Streaming jobs: they join a source, the operators that batch jobs use too, and a sink."""

from meterline.streaming.jobs import (
    await_all,
    dedup_stream,
    start_balances,
    start_consumption,
    start_mediation,
    start_rating,
    start_sessions,
    window_sums,
)
from meterline.streaming.metrics import BatchMetrics, read_batch_metrics

__all__ = ["BatchMetrics", "await_all", "dedup_stream", "read_batch_metrics", "start_balances", "start_consumption", "start_mediation", "start_rating", "start_sessions", "window_sums"]
