"""The warehouse: models bound to canonical column names, checks, metrics and report datasets."""
