"""Readers of grid files, listings, catalogues, polygons, points and configurations."""
