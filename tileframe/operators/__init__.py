"""Operators of the geospatial engine."""
