"""Structured Streaming forms of scoring and of the weekly aggregate."""
