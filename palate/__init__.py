"""Rating, tag and item-vector analytics as Spark DataFrame operators."""
