"""stratalake: layered-lake analytics as plain Spark DataFrame functions."""
