"""The given tables seen as posts and prices, and SQL equivalents of the queries."""
