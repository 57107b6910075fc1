"""Month-by-month analytics on Spark: sources, typed games, aggregates, publishing and serving queries."""
