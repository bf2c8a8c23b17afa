"""Spark jobs for periodic sensor readings: decode, land, alert, summarise."""
