"""Wayline: parse, type, enrich and deduplicate delimited log lines with PySpark."""
