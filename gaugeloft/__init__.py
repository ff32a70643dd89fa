"""Telemetry and point-cloud analytics expressed as Spark DataFrame jobs."""
