"""trackgrid: lap telemetry analytics as Spark DataFrame operations."""
