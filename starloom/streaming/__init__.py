"""Structured Streaming: micro-batch keyed upsert of the incremental models."""

from .upsert_stream import read_raw_stream, start_upsert_stream

__all__ = ["read_raw_stream", "start_upsert_stream"]
