"""Column-expression helpers (JVM-side built-ins, no Python UDFs)."""
