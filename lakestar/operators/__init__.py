"""Transformations from data frames to data frames."""
