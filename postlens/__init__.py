"""Job posting analytics on Spark: statistics, search, rules, roadmaps, models and what-if."""
