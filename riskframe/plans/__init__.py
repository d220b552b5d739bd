"""Registered queries: each is a Spark DataFrame plan over the driver tables
plus, where SQL can express it, an equivalent SQL text for DuckDB."""
