"""Structured Streaming forms of the bar, news and monitoring jobs."""
