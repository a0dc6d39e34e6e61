"""strata: Spark-native tabular profiling, cleaning and classification.

Every operator is a function from DataFrame to DataFrame; the heavy work runs
on executors as DataFrame / Spark SQL / MLlib jobs.  Only aggregated frames
whose size is bounded by the number of columns, classes or models ever reach
the driver.
"""

__version__ = "0.1.0"
