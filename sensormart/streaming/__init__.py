"""Structured Streaming entry points."""

from sensormart.streaming.runs import start_stream

__all__ = ["start_stream"]
