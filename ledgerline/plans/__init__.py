"""Plans: the end-to-end job and the registry of named queries (with their
DuckDB oracle text) used by the driver contract and the bench."""
