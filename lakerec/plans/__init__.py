"""Serving queries and batch jobs composed from the operators."""
