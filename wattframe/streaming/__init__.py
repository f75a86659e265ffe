"""Structured Streaming ingest of landed feed files."""

from wattframe.streaming.ingest import generation_stream, start_generation_ingest

__all__ = ["generation_stream", "start_generation_ingest"]
