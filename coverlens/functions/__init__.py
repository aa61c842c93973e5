"""Column-expression helpers (JVM built-ins only; no Python UDFs)."""
