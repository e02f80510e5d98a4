"""Readers, sinks and the review views over the test tables."""
