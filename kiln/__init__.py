"""kiln: table-in / table-out analytics operators on Spark DataFrames.

Every operator is a function ``(DataFrame, params) -> DataFrame`` that stays
lazy; fitted state is either a handful of driver-side scalars or a DataFrame
that is joined back.  Sub-packages:

* ``sources``   – readers, writers and the proxy tables built from the driver data
* ``functions`` – column-level helpers (dates, math, text)
* ``operators`` – cleaning, joins, aggregates, windows, features, models, metrics
* ``plans``     – multi-operator plans (weekly priority, scoring) and the query catalogue
* ``streaming`` – Structured Streaming twins of the batch jobs
"""

from kiln.session import get_spark, checkpoint_dir, scratch_path

__all__ = ["get_spark", "checkpoint_dir", "scratch_path"]
