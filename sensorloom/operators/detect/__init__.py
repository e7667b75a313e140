"""Anomaly and drift detectors."""
