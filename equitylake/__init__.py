"""Exchange-data analytics as Spark DataFrame operators."""
