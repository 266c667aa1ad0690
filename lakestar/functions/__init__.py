"""Column expressions, all built in and evaluated in the JVM."""
