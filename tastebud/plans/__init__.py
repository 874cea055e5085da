"""Query registry (``catalog``) and its DuckDB oracle SQL (``oracle``)."""
