"""Column expressions; all are Spark built-ins, so they stay inside generated code."""
