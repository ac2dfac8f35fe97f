"""Meterflow: Spark-native analytics for utility-meter telemetry."""
