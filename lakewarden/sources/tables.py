"""Reading: named tables, landed files, foreign tables, column metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUSTOMERS_CSV = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("street_address", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("created_date", T.DateType()),
])
TRANSACTIONS_CSV = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("transaction_date", T.DateType()),
])
INTERACTIONS_CSV = T.StructType([
    T.StructField("interaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("interaction_type", T.StringType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("interaction_date", T.DateType()),
])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. A given schema saves the extra pass that inference needs."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def federated_options(
    url: str,
    table: str,
    partition_col: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """JDBC options; with a partition column the foreign table is read by ``partitions`` tasks."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_col is not None:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options |= {
            "partitionColumn": partition_col,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_federated(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """A table of an external database. Filters and columns are pushed to it; nothing is kept here."""
    return spark.read.format("jdbc").options(**federated_options(url, table, **kwargs)).load()


def column_rows(table: str, df: DataFrame) -> list[tuple[str, str, str, int]]:
    """(table, column, type, ordinal) of one table; its size is the table's width."""
    return [(table, f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(df.schema.fields)]


def columns_table(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column of the given tables, from their schemas alone."""
    rows = [row for name, df in tables.items() for row in column_rows(name, df)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, ordinal int")


def column_counts(table: str, df: DataFrame) -> DataFrame:
    """Columns of one table with its rows and those that hold a value, in one aggregate."""
    filled = [F.count(F.col(f"`{c}`")).alias(f"filled_{i}") for i, c in enumerate(df.columns)]
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *filled)
    described = [
        F.struct(
            F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.lit(dt).alias("data_type"),
            F.lit(i).alias("ordinal"), F.col("n_rows"), F.col(f"filled_{i - 1}").alias("filled_rows"),
        )
        for t, c, dt, i in column_rows(table, df)
    ]
    return counts.select(F.inline(F.array(*described)))


def file_inventory(df: DataFrame) -> DataFrame:
    """Files behind a table with their size, time and number of rows."""
    meta = F.col("_metadata")
    return df.groupBy(
        meta["file_path"].alias("file_path"),
        meta["file_size"].alias("file_size"),
        meta["file_modification_time"].alias("modified_at"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))
