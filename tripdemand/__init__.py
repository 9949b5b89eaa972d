"""Trip-demand analytics on Spark.

Monthly trip files from two services are cleaned into one canonical trip
schema, loaded into a star schema (trips, zones, operators, hourly weather),
rolled up into hourly and zone-level demand aggregates, reported on, and used
to train and score an hourly demand model.

Every operator is DataFrame in, DataFrame out, built from Spark's built-in
functions and Spark ML; there is no Python UDF anywhere in the package.
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
