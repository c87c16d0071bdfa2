"""Statistics over a log of summary requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def request_stats(df: DataFrame, group_by: Sequence[str] = (),
                  stamp: bool = False) -> DataFrame:
    """Requests by outcome, and response times of the successful ones (0 when there are none)."""
    def outcomes(status: str) -> Column:
        return F.count_if(F.coalesce(F.col("status") == status, F.lit(False)))

    took = F.when(F.col("status") == "success", F.col("response_time"))

    def or_zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    stats = df.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("total_requests"),
        outcomes("success").alias("successful_responses"),
        outcomes("error").alias("error_responses"),
        outcomes("exception").alias("exceptions"),
        outcomes("validation_error").alias("validation_errors"),
        or_zero(F.avg(took)).alias("avg_response_time"),
        or_zero(F.max(took)).alias("max_response_time"),
        or_zero(F.min(took)).alias("min_response_time"),
    )
    return stats.withColumn("timestamp", F.current_timestamp()) if stamp else stats
