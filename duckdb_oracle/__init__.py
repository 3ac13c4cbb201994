"""DuckDB reference SQL used to verify the engine (not part of the engine)."""
