"""Costs that must not grow with a square, or in one task."""

import random
import time

from lakewarden.llm import queries, secrets, token_files
from tests.llm import brute

SCHEMA = "doc_id long, text string, source string, n_chars long"


def test_many_matches_of_one_text_cost_linear_time(spark):
    rng = random.Random(0)

    def seconds(n):
        text = " ".join(f"{rng.getrandbits(128):032x}" for _ in range(n))
        df = spark.createDataFrame([(1, text, "a", len(text))], SCHEMA)
        at = time.perf_counter()
        assert len(secrets.judged(df).first().spans) == n
        assert secrets.redact_live(df).first().text == " ".join(["[SECRET]"] * n)
        return time.perf_counter() - at

    seconds(100)
    few, many = seconds(16_000), seconds(32_000)
    assert many < 3 * few


def test_cuts_across_blocks_equal_plain_redaction(spark, monkeypatch):
    """Spans at, before and across the ends of blocks, characters of several bytes, neighbours and overlaps."""
    monkeypatch.setattr(secrets, "BLOCK_CHARS", 8)
    rng = random.Random(5)
    parts = ["é", "𝄞x", " ", "secret=", "0123456789abcdef0123", "AKIA" + "Z" * 16, "password: ", "\n", "token='", "eyJ" + "a" * 9 + "." + "b" * 9 + "." + "c" * 9]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(60)] + ["", "0123456789abcdef", "x" * 8 + "0123456789abcdef"]
    df = spark.createDataFrame([(i, t, f"s{i}", 0) for i, t in enumerate(texts)], SCHEMA)
    spans = {r._row.doc_id: [(s.start, s.end, s.live) for s in r.spans] for r in secrets.judged(df).collect()}
    got = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact_live(df).collect()}
    for i, text in enumerate(texts):
        assert [(s, e) for s, e, _ in spans[i] if (s, e) in {(b, c) for _, b, c in brute.secret_base(text)}]  or not brute.secret_base(text)
        out, at = "", 0
        for s, e, live in sorted(spans[i]):
            if live:
                if s >= at:
                    out += text[at:s] + "[SECRET]"
                at = max(at, e)
        want = out + text[at:]
        assert got[i] == (want, len(want) if any(x[2] for x in spans[i]) else 0)


def test_token_files_are_read_by_many_tasks(spark, tmp_path):
    docs = spark.createDataFrame([(i, "some words here " * 50) for i in range(200)], "doc_id long, text string")
    manifest = token_files.write_token_files(docs, queries.BYTE_VOCABULARY, str(tmp_path / "t"), file_ids=1000)
    files, read = manifest.count(), token_files.read_token_files(manifest)
    assert files >= 20 and read.rdd.getNumPartitions() == files
    assert read.count() == 200
