"""Customer-lifecycle analytics as Spark DataFrame operators."""
