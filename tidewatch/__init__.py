"""Endpoint-telemetry and corpus analytics on Spark."""
