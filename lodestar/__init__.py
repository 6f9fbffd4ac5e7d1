"""lodestar: tabular machine-learning pipeline operators on Spark DataFrames.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects and
is expressed with built-in Spark SQL expressions wherever possible so that
Catalyst can prune, push down and code-generate the work.
"""

__version__ = "0.1.0"
