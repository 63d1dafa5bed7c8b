"""Registry analytics on Spark: sources, cleaning, quality rules, merges, diffs, queries and exports."""
