"""Market-data analytics and feature building on Spark."""
