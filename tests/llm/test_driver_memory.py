"""pipeline, round 3: what the driver has to plan, compile and start does not grow with the rounds of a loop."""

from pyspark.sql import functions as F

from lakewarden import session
from lakewarden.llm import components, minhash, quality


def _jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def test_rounds_of_the_votes_share_their_code(spark):
    rows = [tuple((n * (i + 3) + n // 5) % 3 - 1 for i in range(len(quality.RULES))) for n in range(60)]
    voted = spark.createDataFrame(rows, ", ".join(f"{r} int" for r in quality.RULES))
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME()
    quality.fit_votes(voted, rounds=2, tolerance=0.0)
    code, jobs = compiled.getCount(), _jobs(spark)
    quality.fit_votes(voted, rounds=12, tolerance=0.0)
    assert compiled.getCount() - code < 6 and _jobs(spark) - jobs <= 12 + 4


def test_votes_that_are_missing_and_no_votes(spark):
    kinds = ", ".join(f"{r} int" for r in quality.RULES)
    none = spark.createDataFrame([], kinds)
    assert quality.fit_votes(none).good == quality.GOOD_SHARE
    rows = [(None, *[1] * 8), (-1, *[0] * 8)]
    model = quality.fit_votes(spark.createDataFrame(rows, kinds), rounds=3)
    got = spark.createDataFrame([(None, *[1] * 8), (0, *[1] * 8)], kinds).select(model.posterior()).collect()
    assert got[0] == got[1]


def test_stars_need_no_round(spark, rows, monkeypatch):
    staged = []
    monkeypatch.setattr(session, "watchers", [lambda df, label: staged.append(label)])
    stars = spark.createDataFrame([(5, 1), (1, 6), (7, 2), (3, 3)], "a long, b long")
    assert rows(components.components(stars)) == [(1, 1), (2, 2), (5, 1), (6, 1), (7, 2)]
    assert staged == ["edges", "least"]
    path = spark.createDataFrame([(i, i + 1) for i in range(-4, 9)], "a long, b long")
    assert rows(components.components(path)) == sorted(((i, -4) for i in range(-4, 10)), key=repr)


def test_classes_are_found_in_one_aggregate(spark, rows, monkeypatch):
    """NULL ids last, of repeated ids the first row."""
    staged = []
    monkeypatch.setattr(session, "watchers", [lambda df, label: staged.append(label)])
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(None, text, 1), (4, text, 2), (4, text, 3), (9, text, 4), (None, "x y", 5)], "doc_id long, text string, n int").coalesce(1)
    got = minhash.near_duplicates(df).select(F.col("_row.n"), "class_id", "class_size", "kept")
    assert rows(got) == [(1, 4, 4, False), (2, 4, 4, True), (3, 4, 4, False), (4, 4, 4, False), (5, None, 1, True)]
    assert staged[-2:] == ["classed", "facts"]
