"""Supplier / part / delivery analytics and table-change jobs on Spark."""
