"""Operators for large training-data pipelines; each module holds one operator."""
