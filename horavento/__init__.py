"""Hourly weather-station analytics as Spark DataFrame operators.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects (or
``Column`` expressions for scalar functions), so Catalyst sees one declarative
plan from the scan to the sink.
"""

from horavento.session import checkpoint_root, get_session, scratch_path

__all__ = ["get_session", "checkpoint_root", "scratch_path"]
