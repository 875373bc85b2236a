"""Column functions: calendar periods, geometry, names and statuses."""
