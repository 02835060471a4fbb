"""Forecast-index and ensemble analytics as Spark DataFrame operators."""
