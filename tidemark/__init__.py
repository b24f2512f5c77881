"""Market-bar and open-interest analytics on Spark."""
