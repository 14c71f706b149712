"""Query catalog: every registered query, its Spark plan and its DuckDB oracle."""
