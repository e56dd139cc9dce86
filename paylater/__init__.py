"""Pay-later analytics warehouse on Spark.

Every operator is a lazy function ``DataFrame(s) + parameters -> DataFrame``
built from ``pyspark.sql.functions``; nothing here collects to the driver.
The run date is a parameter (:class:`paylater.context.RunContext`), so the
same inputs always give the same outputs.
"""

from paylater.context import RunContext, build_session, shared_dir

__all__ = ["RunContext", "build_session", "shared_dir"]
