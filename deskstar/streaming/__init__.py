"""Incremental ticket loads with Structured Streaming."""
