"""Tables (S7-S8, R4): Parquet under a directory, or JDBC if a URL is given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()


def write_jdbc(df: DataFrame, url: str, table: str, clear: bool = False, **options: str) -> None:
    """Adds the rows to a table of a database, one connection per partition, or replaces its rows (the table itself stays)."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("truncate", "true").options(**options).mode("overwrite" if clear else "append").save()


def write(df: DataFrame, path: str, clear: bool = True) -> None:
    """Replaces the table, or adds to it."""
    df.write.mode("overwrite" if clear else "append").parquet(path)


def create(spark: SparkSession, name: str, schema: T.StructType, reset: bool = False) -> None:
    """S8."""
    if reset:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema.fields)}) USING parquet")
