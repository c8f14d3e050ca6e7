"""Batch and stream transforms, each from DataFrame to DataFrame."""
