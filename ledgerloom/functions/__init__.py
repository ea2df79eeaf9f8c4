"""Column expressions: everything here stays in the JVM and takes and returns columns."""
