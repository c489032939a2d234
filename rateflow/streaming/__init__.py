"""Structured Streaming operators."""

from rateflow.streaming.deltas import current_fold, run_delta_stream, stream_apply_deltas  # noqa: F401
