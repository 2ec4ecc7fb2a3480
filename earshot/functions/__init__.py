"""Column expressions (all built-in, JVM side; no Python UDF)."""
