"""Operators over the grid, region, inventory and catalogue tables."""
