from adgleaner.functions import text, values, web

__all__ = ["text", "values", "web"]
