"""Composed jobs (flagship crawl_next, crawl_step) and the registered query catalog."""
