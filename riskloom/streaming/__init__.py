"""Structured Streaming jobs: parse, dedupe, point-in-time features, scoring and monitoring."""
