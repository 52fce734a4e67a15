"""Reusable relational operators: keys, lookups, quality checks, daily series, versioning."""
