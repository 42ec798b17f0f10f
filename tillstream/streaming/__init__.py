"""The jobs as Structured Streaming queries. Every `start_*` returns the running query."""
