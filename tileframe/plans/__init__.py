"""Plans of the geospatial engine."""
