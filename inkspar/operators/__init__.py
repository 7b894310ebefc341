"""Relational operators over archive tables, as DataFrame transforms."""
