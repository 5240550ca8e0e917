"""Column functions and UDFs."""
