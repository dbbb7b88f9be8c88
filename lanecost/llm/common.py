"""What several operators share: reading, written intermediate tables, numbering."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanecost.sources.folders import shared_folder

_shipped: set[str] = set()


@cache
def _archive() -> str:
    """The package as an archive that workers can import from."""
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="lanecost-")) / "lanecost.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    atexit.register(shutil.rmtree, path.parent, ignore_errors=True)
    return str(path)


def ship(spark: SparkSession) -> None:
    """Give the package to the workers of a session, wherever it was started from;
    once for a Spark application, before the first operator that runs Python."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_archive())
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """The rows as a Parquet table in the folder all executors share. It cuts the
    lineage: a lost executor costs a reread, never a second run of what is above."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, limit: int = 20_000) -> DataFrame:
    """A table marked for broadcast if it is counted to have at most ``limit`` rows;
    otherwise left to Spark's own choice of join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8(text: Column) -> Column:
    """The bytes of a text, none for a null."""
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def numbered(
    df: DataFrame,
    group: str,
    order: list[str],
    name: str,
    rows_per_chunk: int = 5_000,
) -> DataFrame:
    """Adds the column ``name``: 0, 1, 2, ... inside each ``group``, without gaps.

    No task holds a whole group. Rows are cut into chunks by a hash of all ``order``
    columns, so that many rows of one key, or of none, are spread, each (group, chunk) is
    numbered by itself, and the rows before it are added from a table of counts. Rows
    alike in every ``order`` column are numbered in any order. The group must not be null.
    """
    chunks = max(1, math.ceil(df.count() / rows_per_chunk))
    chunk = F.pmod(F.xxhash64(*order), F.lit(chunks))
    before = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(group, chunk.alias("_chunk"))
        .count()
        .select(group, "_chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(group, "_chunk").orderBy(*order)
    rows = df.withColumn("_chunk", chunk).withColumn("_nth", F.row_number().over(inside).cast("long"))
    return (
        rows.join(offsets, [group, "_chunk"])
        .withColumn(name, F.col("_offset") + F.col("_nth") - 1)
        .select(*df.columns, name)
    )
