"""Text and opinion analytics on Spark."""
