"""The same layers fed by Structured Streaming."""
