"""Column-expression builders (pure Spark SQL functions, no UDFs)."""
