"""Column expressions shared by the operators; each returns a built-in Spark expression."""
