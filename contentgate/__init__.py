"""Content-safety analytics on Spark tables and streams."""
