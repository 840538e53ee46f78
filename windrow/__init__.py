"""Notice preparation and analytics on Spark."""
