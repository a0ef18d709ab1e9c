"""Weather-radar volume analytics as Spark DataFrame operators.

Every operator takes and returns lazy DataFrames keyed by volume, so one job
covers any number of radars and volumes.  NULL is the only missing value.
"""
