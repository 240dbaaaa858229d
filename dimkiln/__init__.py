"""dimkiln: a Spark-native loader for Kimball dimensions.

Every operator is a function from DataFrames to DataFrames built on Spark's
joins, windows and aggregates, so Catalyst plans the work and the executors
run it. Only metadata, counts and per-partition offsets reach the driver.
"""

from dimkiln.spec import DimensionSpec, spec_from_mapping

__all__ = ["DimensionSpec", "spec_from_mapping"]
__version__ = "0.1.0"
