"""Column functions: native expressions first, Arrow batches for what Spark lacks."""
