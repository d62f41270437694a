"""Layered order analytics on Spark: raw -> clean -> star, with quarantine and checks."""

__all__ = ["schemas", "session", "functions", "sources", "operators", "plans"]
