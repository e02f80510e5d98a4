"""Spark-native review of scored tabular models: quality, drift, calibration, lift, risk."""
