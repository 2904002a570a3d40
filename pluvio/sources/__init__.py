"""Readers for telemetry, link metadata, polygons and stored frames."""
