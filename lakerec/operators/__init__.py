"""Operators over DataFrames. ``als`` and ``matching`` also store intermediate tables and collect sides of checked size."""
