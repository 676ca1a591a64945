"""terrarank — composite-indicator analytics on Spark DataFrames.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects and
is parameterised by the entity key, year and class columns, so the same plans
run on any entity × class × year table.
"""

from terrarank.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
__version__ = "0.1.0"
