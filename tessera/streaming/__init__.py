"""Structured Streaming: event-time volume (T1) and incremental refresh."""
