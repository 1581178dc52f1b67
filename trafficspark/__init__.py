"""Snapshots of moving entities as clean tables, hourly series, report datasets and forecasts on Spark."""
