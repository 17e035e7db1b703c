"""Movement and trajectory operators on Spark DataFrames.

Instants are UTC and held as TIMESTAMP_NTZ, so no result depends on the session time zone.
"""
