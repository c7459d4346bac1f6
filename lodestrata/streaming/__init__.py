"""Structured Streaming jobs: bounded runs with committed progress."""
