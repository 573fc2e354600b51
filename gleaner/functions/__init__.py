"""Column functions built on Spark SQL built-ins."""
