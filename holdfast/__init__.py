"""Customer-retention analytics as DataFrame-to-DataFrame operators on Spark."""
