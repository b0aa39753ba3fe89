"""Structured Streaming twins of three batch operators.

Each reads a folder or file of Parquet with a given schema, takes what is there and stops
(``availableNow``); started again with the same folders it goes on with new files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.functions.scalars import exact_sum
from lakewarden.operators.classify import pii_findings
from lakewarden.operators.integrity import tag_failures


def open_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _run(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def window_profile(df: DataFrame, ts: str, by: str, value: str, every: str = "1 day",
                   scale: int | None = None) -> DataFrame:
    """Rows, nulls and sum per time window and key, ``scale`` as in ``exact_sum``. Works on a batch and on a stream."""
    return (
        df.groupBy(F.window(ts, every).alias("w"), F.col(by))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(value).isNull()).alias("nulls"),
             exact_sum(value, scale).alias("total"))
        .select(F.col("w.start").alias("window_start"), by, "n_rows", "nulls", "total")
    )


def stream_profile(spark: SparkSession, path: str, schema: T.StructType, ts: str, by: str, value: str,
                   out: str, checkpoint: str, late: str | None = None, scale: int | None = None) -> DataFrame:
    """Continuous profile; the state is one row per window and key, not the rows of the stream.

    Without ``late`` each trigger replaces the published profile, so rows of any age are counted.
    With it ("2 days") a window is published once, when the newest row is that much past its end;
    its state is then dropped and rows that come even later are not counted.
    """
    events = open_stream(spark, path, schema).withColumn(ts, F.col(ts).cast("timestamp"))
    if late is not None:
        profiled = window_profile(events.withWatermark(ts, late), ts, by, value, scale=scale)
        target = f"{out}/closed"
        _run(profiled.writeStream.outputMode("append").format("parquet").option("path", target), checkpoint)
        return spark.read.schema(profiled.schema).parquet(target)

    profiled = window_profile(events, ts, by, value, scale=scale)
    target = f"{out}/profile"

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    _run(profiled.writeStream.outputMode("complete").foreachBatch(replace), checkpoint)
    return spark.read.schema(profiled.schema).parquet(target)


def stream_quarantine(spark: SparkSession, path: str, schema: T.StructType, rules: dict[str, Column],
                      out: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """Splits arriving rows into good and bad ones in one pass. A repeated batch overwrites its own folder."""
    verdict = F.when(F.size("failed") == 0, "good").otherwise("bad")
    tagged = tag_failures(open_stream(spark, path, schema), rules).withColumn("verdict", verdict)

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("verdict").parquet(f"{out}/rows/batch_id={batch_id}")

    _run(tagged.writeStream.foreachBatch(split), checkpoint)
    rows = spark.read.schema(T.StructType([
        *schema.fields, T.StructField("failed", T.ArrayType(T.StringType())),
        T.StructField("batch_id", T.LongType()), T.StructField("verdict", T.StringType()),
    ])).parquet(f"{out}/rows").drop("batch_id")
    good, bad = (rows.filter(F.col("verdict") == v).drop("verdict") for v in ("good", "bad"))
    return good.drop("failed"), bad


def stream_pii_scan(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], text_col: str,
                    out: str, checkpoint: str) -> DataFrame:
    """Personal-data findings of arriving texts, appended as they come."""
    found = pii_findings(open_stream(spark, path, schema), keys, text_col)
    _run(found.writeStream.outputMode("append").format("parquet").option("path", f"{out}/findings"), checkpoint)
    return spark.read.schema(found.schema).parquet(f"{out}/findings")
