"""Warehouse models: bronze loads, dimensions, fact, views, reports, pipeline."""
