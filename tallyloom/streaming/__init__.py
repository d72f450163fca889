"""Structured Streaming jobs and idempotent sinks."""
