"""Structured Streaming jobs: landing, changelog sinks, compaction, fan-out."""
