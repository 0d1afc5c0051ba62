"""Daily star-schema warehouse as Spark DataFrame operators."""
