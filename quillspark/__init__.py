"""A PySpark engine for archives of literary works: extraction, merging, exports and queries."""
