"""Column functions: take columns, return columns, never leave the JVM."""
