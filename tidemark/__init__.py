"""Layered retail analytics on Spark tables and streams."""
