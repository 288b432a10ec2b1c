"""Tick files to 1-minute bars on Spark: load, aggregate, merge, catalog, quality."""
