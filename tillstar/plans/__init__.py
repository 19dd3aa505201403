"""Analytics, load and report queries."""
