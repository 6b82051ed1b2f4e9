"""Change-log analytics on Spark: state, aggregates, windows and quality checks."""
