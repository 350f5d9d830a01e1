"""tidalframe: panel, customer and model analytics written as Spark DataFrame jobs."""
