"""Readers, landing, table writes and the external lookup."""
