"""Rainfall analytics on commercial microwave links, written for Spark."""
