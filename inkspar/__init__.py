"""inkspar: a PySpark engine for building, checking and querying document archives."""
