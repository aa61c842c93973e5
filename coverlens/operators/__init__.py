"""DataFrame -> DataFrame operators of the engine, grouped by the reference's jobs."""
