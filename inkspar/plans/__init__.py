"""Named queries over the test tables, each with its DuckDB counterpart where SQL can express it."""
