"""Indices over grid files as they arrive."""
