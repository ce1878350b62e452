"""PySpark operators for curating listings, news and events."""
