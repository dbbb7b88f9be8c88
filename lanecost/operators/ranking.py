"""Top members with ties."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Up to so many ranks Spark cuts every partition down before it ranks the rest
# (spark.sql.optimizer.windowGroupLimitThreshold).
_RANKED = 1_000


def top_with_ties(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows whose ``value`` ranks among the ``n`` largest; a row without a value
    has no rank.

    Each partition is cut down to its own first ``n`` ranks before a single task ranks
    the rest. For more ranks than that is done for, the ``n``-th largest value is looked
    up by a distributed sort, and the rows that reach it are kept."""
    valued = df.where(F.col(value).isNotNull())
    if n <= _RANKED:
        ranked = valued.withColumn("_rank", F.rank().over(Window.orderBy(F.col(value).desc())))
        return ranked.where(F.col("_rank") <= n).drop("_rank")
    last = valued.select(value).orderBy(F.desc(value)).limit(n).agg(F.min(value)).scalar()
    return valued.where(F.col(value) >= last)
