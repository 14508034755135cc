"""Readers and publishers of tables."""
