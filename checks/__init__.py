"""Queries for the driver, their SQL, and the crawl data derived from the given tables."""
