"""Column functions: each takes and returns columns, and runs inside the JVM."""
