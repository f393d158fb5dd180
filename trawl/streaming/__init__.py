"""Structured Streaming forms of the crawl step, URL de-duplication, metrics, evaluation and HITS windows."""
