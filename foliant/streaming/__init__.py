"""The crawl as Structured Streaming."""
