"""Column -> Column helpers; everything here is built-in Spark expressions."""
