"""Column-level helpers that stay inside the JVM."""
