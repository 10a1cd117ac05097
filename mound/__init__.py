"""mound: pitch-log analytics and game-outcome modelling on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from
``pyspark.sql.functions`` so that Catalyst can prune, push down and
codegen the whole plan.  Nothing here collects data to the driver.
"""

__version__ = "0.1.0"
