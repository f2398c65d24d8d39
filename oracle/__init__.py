"""Independent SQL for the queries of the engine, run by DuckDB in checks."""
