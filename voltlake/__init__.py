"""Layered time-series tables (Bronze, Silver, Gold) as plain Spark DataFrame operators."""
