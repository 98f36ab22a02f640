"""Spark-native analytics for irregular station observations.

Every operator takes and returns DataFrames, works on all stations in one plan (the station is a key,
never a loop) and holds no session of its own.
"""
