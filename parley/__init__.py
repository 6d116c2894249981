"""Discussion-stream analytics as plain Spark DataFrame transformations."""
