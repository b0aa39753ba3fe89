"""Streams equal their batch twins, go on with new files and survive a repeated batch."""

from pyspark.sql import functions as F

from lakewarden.operators.classify import pii_findings
from lakewarden.session import shared_path
from lakewarden.streaming import jobs


def _events(spark, lo, hi):
    return spark.range(lo, hi).select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=F.col("id") % 72)).alias("ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("kind"),
        F.when(F.col("id") % 7 != 0, F.col("id").cast("double")).alias("value"))


def test_profile_continues_with_late_files(spark, rows):
    base = shared_path(spark, "stream-test")
    source = f"{base}/in"
    schema = _events(spark, 0, 1).schema
    args = (spark, source, schema, "ts", "kind", "value", f"{base}/out", f"{base}/checkpoint")
    for lo, hi in ((200, 400), (0, 200)):  # the second file is older
        _events(spark, lo, hi).write.mode("append").parquet(source)
        streamed = jobs.stream_profile(*args)
        batch = jobs.window_profile(spark.read.parquet(source), "ts", "kind", "value")
        assert rows(streamed) == rows(batch)
    assert rows(jobs.stream_profile(*args)) == rows(batch)


def test_profile_with_watermark_publishes_closed_windows(spark, rows):
    base = shared_path(spark, "stream-test")
    source = f"{base}/in"
    _events(spark, 0, 400).write.parquet(source)
    streamed = jobs.stream_profile(spark, source, _events(spark, 0, 1).schema, "ts", "kind", "value",
                                   f"{base}/out", f"{base}/checkpoint", late="12 hours")
    batch = jobs.window_profile(spark.read.parquet(source), "ts", "kind", "value")
    # The newest row is of the third day, 23:00: only the first two days are 12 hours past their end.
    assert rows(streamed) == rows(batch.filter("window_start < '2024-01-03'"))


def test_quarantine_is_complete_and_disjoint(spark, rows):
    base = shared_path(spark, "stream-test")
    source = f"{base}/in"
    rules = {"has_value": F.col("value").isNotNull(), "small": F.col("value") < 100}
    for lo, hi in ((0, 150), (150, 200)):
        _events(spark, lo, hi).write.mode("append").parquet(source)
        good, bad = jobs.stream_quarantine(
            spark, source, _events(spark, 0, 1).schema, rules, f"{base}/out", f"{base}/checkpoint")
    everything = spark.read.parquet(source)
    assert rows(good.unionByName(bad.drop("failed"))) == rows(everything)
    assert good.filter("value is null or value >= 100").count() == 0
    both = bad.filter(F.size("failed") == 2)
    assert both.count() == everything.filter("value is null").count()


def test_pii_scan(spark, rows):
    base = shared_path(spark, "stream-test")
    source = f"{base}/in"
    schema = "id int, text string"
    for text in ("write to a@b.co", "call (743) 555-3824"):
        spark.createDataFrame([(len(text), text)], schema).write.mode("append").parquet(source)
        found = jobs.stream_pii_scan(spark, source, spark.read.parquet(source).schema, ["id"], "text",
                                     f"{base}/out", f"{base}/checkpoint")
    assert rows(found) == rows(pii_findings(spark.read.parquet(source), ["id"], "text"))
    assert found.count() == 2
