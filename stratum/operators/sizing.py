"""Size checks made before choosing how to join."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fits_broadcast(df: DataFrame) -> bool:
    """True if Spark's own size estimate is within the session's broadcast threshold."""
    plan = df._jdf.queryExecution().optimizedPlan()
    limit = df._jdf.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(plan.stats().sizeInBytes())) <= limit
