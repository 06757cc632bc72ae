"""Streaming jobs and their sinks."""
