"""Whole reviews and the query catalogue."""
