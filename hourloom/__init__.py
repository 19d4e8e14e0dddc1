"""Hourly sensor series on Spark: alignment, index, features, forecasts, reports."""
