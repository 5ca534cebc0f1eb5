"""Analytics for environmental observation networks, written as Spark DataFrame operators.

Every operator takes DataFrames (plus column names) and returns a lazy DataFrame, so the same code
runs on tower, station, track and raster tables of any size and is planned by Catalyst.
"""
