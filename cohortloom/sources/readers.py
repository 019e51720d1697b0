"""Readers.  Every source has an explicit schema; blanks become NULL on the way in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.missing import normalise_blanks

# Fixed value: rows fetched per round trip from the warehouse.
WAREHOUSE_FETCH_ROWS = 40_000

DIRECTORY_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("id", "name", "type", "location", "pronouns")]
)


def snapshot_read(
    spark: SparkSession, path: str, snapshot: str | None = None, condition: Column | None = None,
    date_column: str = "snapshot_date",
) -> DataFrame:
    """Rows of one dated snapshot; the date is a partition column, so only its files are read."""
    df = spark.read.parquet(path)
    if snapshot is not None:
        df = df.filter(F.col(date_column) == F.lit(snapshot))
    return df if condition is None else df.filter(condition)


def warehouse_options(
    url: str, table: str, user: str, password: str, split: tuple[str, str, str, int] | None = None
) -> dict[str, str]:
    """Options of a warehouse read; ``split`` is (column, lower, upper, partitions) for a parallel read."""
    options = {
        "url": url, "dbtable": table, "user": user, "password": password, "fetchsize": str(WAREHOUSE_FETCH_ROWS),
    }
    if split:
        column, lower, upper, partitions = split
        options |= {
            "partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": str(partitions),
        }
    return options


def warehouse_read(spark: SparkSession, **settings) -> DataFrame:
    """A warehouse table over JDBC."""
    return spark.read.format("jdbc").options(**warehouse_options(**settings)).load()


def delimited_read(
    spark: SparkSession, path: str, schema: T.StructType, names: list[str] | None = None, sep: str = "\t"
) -> DataFrame:
    """Delimited text with a header line; ``names`` renames every column by position."""
    df = spark.read.csv(path, sep=sep, header=True, schema=schema, enforceSchema=True)
    return normalise_blanks(df.toDF(*names) if names else df)


def sheet_read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A sheet saved as comma-separated text with a header line."""
    return delimited_read(spark, path, schema, sep=",")


def json_array_read(spark: SparkSession, path: str, record: T.StructType = DIRECTORY_SCHEMA, field: str = "data") -> DataFrame:
    """Records inside the array ``field`` of whole-file JSON documents, one document per file."""
    schema = T.StructType([T.StructField(field, T.ArrayType(record))])
    documents = spark.read.json(path, schema=schema, multiLine=True)
    return documents.select(F.explode(field).alias("_record")).select("_record.*")
