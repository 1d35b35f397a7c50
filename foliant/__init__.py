"""Book-catalog analytics as Spark DataFrame operators."""
