"""Domain data selection on Spark."""
