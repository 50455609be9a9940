"""Prepare, forecast and review many time series at once, on Spark."""
