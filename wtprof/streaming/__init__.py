"""Structured Streaming forms of the session and scoring jobs."""
