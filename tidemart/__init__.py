"""Retail analytics on Spark: logs, change records, orders and their dashboards."""
