"""Spark jobs for governed tables and daily market bars."""
