"""Event-time extensions: the same aggregates over a stream as over a table."""
