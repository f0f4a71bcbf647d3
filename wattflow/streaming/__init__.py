"""Incremental bronze -> silver with Structured Streaming."""

from wattflow.streaming.incremental import generation_stream, run_silver_generation

__all__ = ["generation_stream", "run_silver_generation"]
