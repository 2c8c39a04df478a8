"""Raster and cartographic analytics on Spark: maps as tables of pixels."""
