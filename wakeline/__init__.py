"""Vessel-telemetry analytics on Spark."""
