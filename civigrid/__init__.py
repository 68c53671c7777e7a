"""District registry and point lookup on Spark."""
