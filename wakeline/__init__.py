"""wakeline: vessel-trajectory analytics as Spark DataFrame operators."""
