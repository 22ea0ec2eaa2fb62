"""Shared constants of the session operators (batch and stream)."""

# Output name → input column of the session text, as in the reference layout
# (host is off by default there).
DEFAULT_TEXT = (("agent", "http_agent"), ("query", "http_query"))
