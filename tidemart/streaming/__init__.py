"""Structured Streaming runs."""
