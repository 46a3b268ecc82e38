"""Crawled pages to clean product listings, as Spark DataFrame operators."""
