"""Geospatial analytics on PySpark: tile grids, rasters and vector layers as DataFrames."""
