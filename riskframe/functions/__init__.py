"""Column-expression builders (native Spark expressions, no Python UDFs)."""
