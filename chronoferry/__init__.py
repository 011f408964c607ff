"""Move time-series tables into a tag/field measurement store with Spark."""
