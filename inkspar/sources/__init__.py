"""Readers and writers for the formats that Spark has no source for."""
