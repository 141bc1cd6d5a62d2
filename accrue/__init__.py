"""Event-time consolidation of change data on Spark."""
