"""Prefix trie, hard negatives and language: against plain computations, on odd rows and at small block sizes."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lakewarden.llm import language, negatives, queries, trie
from tests.conftest import SF
from tests.llm import brute

TURNS = "conv_id long, turn long, role string, text string, conv string, pos long, hi long, depth long, block int"
VECTORS = "vec_id long, embedding array<float>, label int, rid long, score long, w int, anchor boolean, part string"


# Trie


def plain_trie(conversations: dict[int, list[tuple[str, str]]]) -> set[tuple]:
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        own = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        saved[k] = own + sum(saved[x] for x in kids[k])
    return {(
        min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
        hashlib.sha256(",".join(str(c) for c in sorted(m) if len(conversations[c]) == len(k)).encode()).hexdigest(),
    ) for k, m in members.items()}


def plain_rebuild(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    by = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [(r.decode(), t.decode()) for _, _, r, t in sorted(v)] for c, v in by.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def nodes(df):
    return [tuple(r) for r in df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]


def trie_rows(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    said = ["", "ja", "né 𝄞", "no", "x" * 30]
    rows = []
    for c in [*range(40), 1000, 1003]:
        for turn in range(rng.choice([0, 1, 2, 3, 9, 25])):
            # Half of the conversations say the same all the time, so deep nodes are shared.
            text = said[0 if c % 2 else 1] if rng.random() < 0.9 else rng.choice(said + [None])
            rows.append((c, turn, rng.choice(["user", "user", None]) if turn > 20 else "user", text, *[None] * 5))
    rows += [rows[3], rows[3], (7, None, None, None, *[None] * 5), (7, None, "system", "a", *[None] * 5), (None, 1, "user", "lost", *[None] * 5)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("span", [1024, 2])
def test_trie_equals_brute_force(spark, monkeypatch, span):
    """NULLs, ties, repeated rows, shared long conversations, clashing names; with spans of blocks as well."""
    monkeypatch.setattr(trie, "SPAN", span)
    rows = trie_rows(span)
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    got = nodes(trie.prefix_trie(*trie.rebuilt(trie.turns_of(df))))
    assert len(got) == len(set(got)) and set(got) == plain_trie(plain_rebuild(rows))


def test_trie_of_long_copies(spark):
    """Copies of one long conversation and its prefixes, with many members on each node."""
    said = [("user" if i % 2 else "assistant", f"turn {i % 7}") for i in range(70)]
    convs = {c: said[:[70, 70, 8, 9, 64, 0][c % 6]] for c in range(120)}
    rows = [(c, i, r, t, *[None] * 5) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    turns = trie.turns_of(spark.createDataFrame(rows, TURNS))
    got = nodes(trie.prefix_trie(turns, spark.createDataFrame([(c,) for c in convs], "conv long")))
    assert len(got) == 71 and set(got) == plain_trie(convs)


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], TURNS)
    assert nodes(trie.prefix_trie(*trie.rebuilt(trie.turns_of(none)))) == []
    blank = spark.createDataFrame([(5, None, None, None, *[None] * 5)], TURNS)
    assert set(nodes(trie.prefix_trie(*trie.rebuilt(trie.turns_of(blank))))) == plain_trie({5: [("", "")]})


def test_trie_is_rolled_up(spark):
    df = spark.createDataFrame(trie_rows(1), TURNS)
    rows, _ = trie._blocks(*trie.rebuilt(trie.turns_of(df)))
    text = trie._rolled(rows)._jdf.queryExecution().toString()
    assert "Expand" in text and "grouping_id" in text


# Hard negatives


def plain_negatives(rows, anchors, positives=5, count=10, low=30, high=90):
    """Rows as (place, id, vector, label); anchors are places."""
    ok = [(p, i, [math.floor(256 * x) for x in v], g) for p, (i, v, g) in enumerate(rows)
          if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for p, i, v, g in ok:
        if p not in anchors:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, q, h) for q, j, w, h in ok if q != p)
        for s, j, _, _ in [x for x in scored if x[3] == g][:positives]:
            fit = [x for x in scored if x[3] != g and low * -s <= 100 * -x[0] <= high * -s][:count]
            out += [(i, j, n, x[1], -s, -x[0]) for n, x in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, anchor):
    df = spark.createDataFrame([(i, v, g, 1, 2, 3, True, "p") for i, v, g in rows], VECTORS)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, anchor).collect())


def vectors(seed, n=400, dims=20):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    out = []
    for i in range(n):
        v = 0.3 * centres[i % 4] + 0.1 * rng.normal(size=dims) + 0.1
        out.append((i, [float(np.float32(x)) for x in v], 0 if i % 3 else int(rng.integers(3))))  # one label holds most rows
    return out


@pytest.mark.parametrize("sizes", [(4096, 4096, 128, 4096), (50, 7, 3, 64), (33, 5, 128, 8)])
def test_negatives_equal_brute_force(spark, monkeypatch, sizes):
    """Blocks of both sides, guesses too high and too low, NULLs, zeros, copies, ties, clashing names."""
    for name, size in zip(("BLOCK_ROWS", "BLOCK_ANCHORS", "TOGETHER", "SAMPLE_ROWS"), sizes):
        monkeypatch.setattr(negatives, name, size)
    rows = vectors(sizes[0])
    zero, flat = [0.0] * 20, rows[5][1]
    rows += [(1000 + i, flat, i % 2) for i in range(40)]  # one vector many times, so scores tie
    rows += [(2000, zero, 0), (2010, zero, 1), (2020, None, 0), (2030, flat, None), (None, flat, 0), (2040, [None] * 20, 0),
             (2050, [float("nan")] * 20, 0), (2060, [float("inf")] * 20, 1), (2070, [], 1), (2080, [-x for x in flat], 0), (2090, flat[:7], 1)]
    anchors = {p for p, (i, _, _) in enumerate(rows) if i is not None and i % 10 == 0}
    assert mined(spark, rows, F.col("vec_id") % 10 == 0) == plain_negatives(rows, anchors)


def test_negatives_of_few_rows(spark):
    assert mined(spark, [], F.col("vec_id") % 10 == 0) == []
    assert mined(spark, [(0, [1.0, 2.0], 1)], F.col("vec_id") % 10 == 0) == []
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [0.5, 1.0], 2), (3, [0.01, 0.0], 2), (0, [1.0, 2.0], 1)]
    assert mined(spark, rows, F.col("vec_id") == 0) == plain_negatives(rows, {0, 4})


def test_large_components_are_exact(spark):
    rows = [(0, [3e5, 1.0], 1), (1, [3e5, 2.0], 1), (2, [2e5, 3.0], 2), (3, [1.5e5, 5.0], 2), (5, [1e9, 1e9], 3)]
    assert mined(spark, rows, F.col("vec_id") == 0) == plain_negatives(rows, {0})


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_all_pairs(seed):
    rng = np.random.default_rng(seed)
    q, y = (np.floor(256 * rng.normal(size=(n, 30)) * np.linspace(2, 0.01, 30)) for n in (17, 300))
    score = q @ y.T
    for least in (np.full(17, -np.inf), np.quantile(score, 0.99, axis=1), np.quantile(score, rng.random(17)), np.full(17, 1e12)):
        i, j, s = negatives.reaching(q, y, least)
        a, b = np.nonzero(score >= least[:, None])
        assert sorted(zip(i, j, s)) == sorted(zip(a, b, score[a, b]))


# Language


def plain_sum(word, table, pieces):
    known = {p: i for i, p in enumerate(pieces.texts)}
    text = language.BEGIN + word
    sums = [1.0] + [0.0] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - pieces.longest), j):
            p = known.get(text[i:j])
            sums[j] += sums[i] * (table[p] if p is not None else language.UNKNOWN if j == i + 1 else 0.0) * language.LIFT ** (j - i)
    return sums[-1]


def test_forward_sums_all_segmentations():
    pieces = language.Pieces(["▁a", "a", "b", "ab", "ba", "▁ab", "abab", "é", "▁"])
    rng = np.random.default_rng(0)
    table = rng.random((len(pieces), 3)) * 0.2
    words = ["a", "ab", "abab", "babab", "é", "zé", "ab" * 20, "x" * 64, "abz"]
    got = language.word_scores(words, pieces, table)
    for word, row in zip(words, got):
        for g in range(3):
            assert row[g] == pytest.approx(math.log(plain_sum(word, table[:, g], pieces)), rel=1e-9)


def test_expected_uses_are_derivatives():
    """The expected uses of a piece are p dlogP/dp."""
    pieces = language.Pieces(["▁a", "a", "b", "ab", "ba", "▁ab", "abab"])
    table = np.random.default_rng(1).random(len(pieces)) * 0.3
    words, counts = ["abab", "babaab", "ab"], np.array([3.0, 1.0, 7.0])
    got = language.expected_uses(words, counts, pieces, table) / language.UNIT
    for k in range(len(pieces)):
        step = table.copy()
        step[k] *= 1 + 1e-6
        want = sum(n * math.log(plain_sum(w, step, pieces) / plain_sum(w, table, pieces)) for w, n in zip(words, counts)) / math.log(1 + 1e-6)
        assert got[k] == pytest.approx(want, abs=1e-3)


def test_language_held_out_accuracy(spark):
    lang = {d["doc_id"]: d["lang"] for d in brute.table(SF, "documents")}
    rows = queries.LLM_QUERIES["op13_language"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert len(held) > 100 and sum(held) >= 0.99 * len(held)


_DOCS = "doc_id long, text string, lang string, _row string, top double, known string, _text string"
_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def said(spark):
    rows = [(i, t, g, *["x"] + [1.0] + ["x"] * 2) for i, (t, g) in enumerate([
        ("the house is over there and the river", "en"), ("das haus ist dort und der fluss", "de"), ("la casa es grande y el río", "es"),
        ("the end of the street", "en"), ("und das ist nicht das ende", "de"), ("que es esto y donde", "es"), (None, "en"), ("", "de"),
        ("unlabelled words", None)] * 3)]
    return spark.createDataFrame(rows, _DOCS)


def test_language_of_odd_rows(spark, said):
    models = language.learn(said, _VOCABULARY)
    odd = [(100, None), (101, ""), (102, " 12, 34!\n_²"), (103, "x"), (104, "THE RIVER"), (105, "z" * 5000), (106, "the house " * 30_000),
           (106, "the house " * 30_000), (None, "das haus"), (107, "世界 мир"), (108, "daś haus")]
    df = spark.createDataFrame([(i, t, None, "x", 1.0, "x", "x") for i, t in odd], _DOCS)
    rows = language.identify(df, models).collect()
    got = [(r._row.doc_id, r.lang_pred, r.score) for r in rows]
    assert len(got) == len(odd) and rows[0]._row.asDict().keys() == {c.name for c in df.schema}
    by = {i: (g, s) for i, g, s in got}
    assert by[100] == by[101] == by[102] == ("und", 0.0)
    assert by[104][0] == by[106][0] == "en" and by[None][0] == by[108][0] == "de"
    assert all(g in ("en", "de", "es", "und") and 0 <= s <= 1 for _, g, s in got)
    assert language.identify(df.limit(0), models).count() == 0


def test_language_without_anything_learnt(spark, said):
    models = language.learn(said.limit(0), _VOCABULARY)
    assert {(r.lang_pred, r.score) for r in language.identify(said, models).collect()} == {("und", 0.0)}


def test_languages_in_turns(spark, said, monkeypatch):
    """More languages than are sent at once: the same answers, from several models."""
    whole = language.identify(said, language.learn(said, _VOCABULARY), carry=["doc_id"]).collect()
    monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", 2)
    models = language.learn(said, _VOCABULARY)
    parts = language.identify(said, models, carry=["doc_id"]).collect()
    assert len(models) == 2
    assert {r._row.doc_id: r.lang_pred for r in parts} == {r._row.doc_id: r.lang_pred for r in whole}


def test_order_of_rows_does_not_matter(spark, said):
    a, b = (language.learn(said.repartition(n), _VOCABULARY)[0].table for n in (1, 5))
    assert (a == b).all()
