"""Operators: analytics, sampling, features, models, metrics, reports."""
