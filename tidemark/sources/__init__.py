"""Where rows come from and where they go: relational and parquet sources, watermarks, bronze files, tables."""
