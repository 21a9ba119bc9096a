"""Sources of the geospatial engine."""
