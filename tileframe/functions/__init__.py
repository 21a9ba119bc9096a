"""Functions of the geospatial engine."""
