"""Streaming of the geospatial engine."""
