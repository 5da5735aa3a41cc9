"""Process mining over event logs, expressed as Spark DataFrame computations."""
