"""Sales analytics for e-commerce tables, written as Spark DataFrame plans."""
