"""tablekit: Spark-native analytics and data-processing operators.

Every operator is a lazy function ``DataFrame(s) -> DataFrame`` built from
Spark SQL / DataFrame primitives so Catalyst and AQE plan the work.
"""

__version__ = "0.1.0"
