"""Sources (S1-S10) and sinks (K1-K5): Spark readers/writers with explicit schemas."""
