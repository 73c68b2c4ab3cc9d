"""Reusable DataFrame operators (joins, aggregates, windows)."""
