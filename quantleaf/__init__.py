"""quantleaf — multi-currency portfolio analytics on Spark.

Bronze → silver → gold as lazy DataFrame plans:

* ``quantleaf.sources``    bronze readers, seeds, proxy bronze over the test tables, ingestion
* ``quantleaf.functions``  column-expression helpers (returns, dates, guards)
* ``quantleaf.operators``  silver cleaning, gold tables, measures, correlation, quality checks
* ``quantleaf.plans``      refresh (M13) and the query catalog (Spark plan + DuckDB oracle SQL)
* ``quantleaf.streaming``  incremental bronze append with Structured Streaming
"""

from quantleaf.config import EngineConfig
from quantleaf.session import get_spark, checkpoint_dir

__all__ = ["EngineConfig", "get_spark", "checkpoint_dir"]
