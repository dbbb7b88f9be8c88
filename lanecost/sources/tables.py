"""The five star tables from Parquet directories, catalog tables or JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecost.operators.convert import convert
from lanecost.schemas import SCHEMAS, TABLES, Star
from lanecost.sources.csv_files import read_csv


def _as_declared(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[table].fields])


def star_from_parquet(spark: SparkSession, root: str) -> Star:
    """One Parquet directory per table below ``root``."""
    return Star.of({t: _as_declared(spark.read.parquet(f"{root}/{t}"), t) for t in TABLES})


def star_from_catalog(spark: SparkSession, database: str) -> Star:
    return Star.of({t: _as_declared(spark.table(f"{database}.{t}"), t) for t in TABLES})


def star_from_jdbc(spark: SparkSession, url: str, **options: str) -> Star:
    """The tables of a database. Pass ``partitionColumn`` and its bounds in
    ``options`` to read in parallel."""

    def load(table: str) -> DataFrame:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
        return _as_declared(reader.options(**options).load(), table)

    return Star.of({t: load(t) for t in TABLES})


def tables_from_csv(spark: SparkSession, root: str) -> tuple[dict, dict]:
    """Typed tables and their rejects from ``<root>/<table>.csv``. A file that is
    missing, has other columns or records of the wrong width raises."""
    typed, rejected = {}, {}
    for table in TABLES:
        columns = SCHEMAS[table].fieldNames()
        text = read_csv(spark, f"{root}/{table}.csv", columns, f"{table}.csv")
        converted = convert(text, table)
        typed[table] = converted.accepted()
        rejected[table] = converted.rejects()
    return typed, rejected
