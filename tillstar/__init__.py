"""Star-schema analytics over order lines, written as Spark DataFrame transformations."""
