"""Structured Streaming jobs: landing, routing, windowed summaries."""
