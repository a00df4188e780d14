"""Continuous intake, quorum and publishing with Structured Streaming."""
