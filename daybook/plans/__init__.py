"""Plans: registered queries, their DuckDB oracles, and the full build."""
