"""Structured Streaming: event time, sealed windows, gap fill."""
