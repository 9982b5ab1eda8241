"""tripforge: destination analytics and recommendation as Spark DataFrame operators.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects.
Rule tables (weights, thresholds, keyword lists) live in ``tripforge.rules``
and are passed as parameters so callers can swap them.
"""

__version__ = "0.1.0"
