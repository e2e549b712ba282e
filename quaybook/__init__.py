"""Order-book analytics on Spark."""
