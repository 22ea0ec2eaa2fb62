"""Sources, sinks and table layout."""
