"""Consecutive numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanecost.sources.folders import shared_folder


def sequential_ids(
    df: DataFrame,
    order_by: str,
    tie_break: str,
    prefix: str = "SIM-",
    digits: int = 5,
) -> DataFrame:
    """Adds ``sequence_id``: ``prefix`` and the row's position, from 1, by
    ``order_by``. Rows with equal ``order_by`` follow the MD5 of ``tie_break``
    (unique per row), so the result does not depend on the order of the input. Rows
    without an order value come first.

    Rows are dealt once, by ranges of value and MD5, so a value that holds a large part
    of them is cut like any other range. They are written in that order; a row's number is
    its place in its task and the rows of the tasks before, of which only the counts, one
    per task, are added up.
    """
    taken = {c.lower() for c in df.columns}
    hashed, place = (next(n for n in (f"{'_' * i}{c}" for i in range(1, 99)) if n not in taken) for c in ("hash", "place"))
    by = [order_by, hashed, tie_break]
    rows = df.withColumn(hashed, F.md5(F.col(tie_break).cast("string")))
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop(hashed)
    rows = rows.withColumn(place, F.monotonically_increasing_id())
    spark = df.sparkSession
    path = shared_folder(spark, "numbered")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)

    task = F.shiftright(place, 33)
    counts = rows.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1
    shifts = counts.select(F.col("task").alias(f"{place}_task"), shift.alias(f"{place}_shift"))
    number = (F.col(place) + F.col(f"{place}_shift")).cast("string")
    padded = F.when(F.length(number) < digits, F.lpad(number, digits, "0")).otherwise(number)
    placed = rows.join(shifts, task == F.col(f"{place}_task"))
    return placed.select(*(rows[c] for c in df.columns), F.concat(F.lit(prefix), padded).alias("sequence_id"))
