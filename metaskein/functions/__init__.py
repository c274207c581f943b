"""Column helpers used by the operators; every one is a Spark built-in expression."""
