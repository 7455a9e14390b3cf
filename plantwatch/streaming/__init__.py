"""The same tables kept up to date by Structured Streaming."""
