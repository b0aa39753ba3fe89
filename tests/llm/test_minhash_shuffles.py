"""op8_minhash, round 3: what is shuffled does not depend on what the planner happens to broadcast."""

import random
import re

from lakewarden import session
from lakewarden.llm import minhash
from tests.llm import brute
from tests.test_plans import plan


def _texts():
    rng = random.Random(3)
    texts = []
    for g in range(4):
        base = [f"g{g}w{rng.randrange(200)}" for _ in range(100)]
        for i in range(6):
            texts.append(" ".join(base[:k] + [f"n{i}"] + base[k + 1:] if (k := rng.randrange(1, 99)) and i else base))
            texts.append(" ".join([*base[i * 5:], *(f"e{g}x{i}y{k}" for k in range(i * 5))]))
    return texts


def test_sets_and_members_are_shuffled_once(spark, monkeypatch):
    """Without broadcasts by size: signatures and texts are dropped where they are read, a pair of texts meets once, and the
    members of open buckets are laid out once for both sides of their join."""
    plans = {}
    monkeypatch.setattr(session, "watchers", [lambda df, label: plans.setdefault(label, plan(df))])
    rows = [{"doc_id": i, "text": t} for i, t in enumerate(_texts())]
    df = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = {r._row.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert got == brute.op8(rows)
    assert "ReusedExchange" in plans["across"]
    assert "BroadcastHashJoin" in plans["members"] and "BroadcastHashJoin" in plans["buckets"]
    assert plans["compared"].count("MapInArrow (") == 2
    assert [label for label, text in plans.items() if re.search("array_except", text)] == ["compared"]


def test_rows_of_numbers_in_either_way(spark, monkeypatch):
    """Row numbers of several scan partitions, by bits and, beyond the bound, by a join."""
    numbers = [0, 1, 32767, 32768, 32769, (1 << 33) + 5, (7 << 33) + 32768]
    df = spark.createDataFrame([(n, str(n)) for n in numbers], "rid long, _text string")
    ids = spark.createDataFrame([(n,) for n in [0, 32768, 32768, (7 << 33) + 32768, 99]], "node long")
    want = [0, 32768, (7 << 33) + 32768]
    assert sorted(r.rid for r in minhash._only(df, "rid", ids, "some").collect()) == want
    monkeypatch.setattr(minhash, "ROW_BITMAPS", 0)
    assert sorted(r.rid for r in minhash._only(df, "rid", ids, "some").collect()) == want
