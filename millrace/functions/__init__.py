"""Column expressions and the few Arrow UDFs Spark has no built-in for."""
