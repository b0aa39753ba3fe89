"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds.

Anchors meet all rows in blocks. Within a block dimensions are ordered by their weight. A row is listed only under
its leading dimensions: from where its remaining norm times that of any anchor cannot reach the least threshold
asked for, the dimensions are left out of the index. Partial scores are accumulated list by list, and rows whose
partial score and remaining norms cannot reach any anchor's threshold drop out; what is left is scored exactly.

A search fills windows: for each anchor the first k rows of a range of scores. Its threshold begins at a guess from
a bounded sample of rows, and is lowered for the windows that were not filled until they are, or their range
ends. A filled window is exact, as all rows above its threshold were looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import named
from lakewarden.session import stage

# Components are multiplied by this and rounded down, so scores are whole numbers.
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# A negative scores between these percentages of the positive.
LOW, HIGH = 30, 90
# Rows and anchors of one block, and anchors scored together.
BLOCK_ROWS, BLOCK_ANCHORS, TOGETHER = 4096, 4096, 128
# The sample that thresholds are guessed from: at most so many rows, and numbers in all.
SAMPLE_ROWS, SAMPLE_NUMBERS = 4096, 2_000_000
# Rows to expect above a guess, in multiples of what a window needs; then the whole range.
GUESSES = (3, 30)
# Dimensions whose lists are added at a time.
STEP = 8
FAR = 1 << 62
# Sums below this are exact in double precision.
EXACT = float(1 << 53)


def _whole(vectors: list, dims: int) -> np.ndarray:
    """Scaled and rounded components; shorter vectors count as followed by zeros."""
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return np.floor(out * SCALE)


def _tails(x: np.ndarray) -> np.ndarray:
    """Norms of what is left from each step on, a little above the true ones."""
    squares = np.add.reduceat(x * x, np.arange(0, x.shape[1], STEP), axis=1)
    left = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([left, np.zeros((len(x), 1))], axis=1)) * (1 + 1e-9)


def reaching(q: np.ndarray, y: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs that score at least the anchor's threshold."""
    if q.size and y.size and np.abs(q).max() * np.abs(y).max() * q.shape[1] >= EXACT:
        score = np.array([[int(a) for a in r] for r in q], object) @ np.array([[int(a) for a in r] for r in y], object).T
        i, j = np.nonzero(score >= least[:, None])
        return i, j, np.array([max(-FAR, min(FAR, s)) for s in score[i, j]], np.int64)
    tq, ty = _tails(q), _tails(y)
    steps = tq.shape[1] - 1
    # The index: a row is listed up to the step from which on it cannot reach the least threshold alone.
    ends = np.full(len(y), steps)
    if least.min() > 0:
        ends = (ty * tq.max(axis=0)[None, :] >= least.min()).sum(axis=1)
        ends = np.minimum(ends, steps)
    rows = np.argsort(-ends, kind="stable")
    rows = rows[ends[rows] > 0]
    ends, listed = ends[rows], y[rows]
    part = np.zeros((len(q), len(rows)))
    for s in range(steps):
        n = int(np.searchsorted(-ends, -s, side="left"))  # rows listed under these dimensions
        if not n:
            break
        span = slice(s * STEP, (s + 1) * STEP)
        part[:, :n] += q[:, span] @ listed[:n, span].T
        if s % 2 and s + 1 < steps:
            rest = np.minimum(ends, s + 1)
            open_ = ((part + _bound(tq, ty[rows], rest)) >= least[:, None]).any(axis=0)
            if open_.mean() < 0.7:
                rows, ends, listed, part = rows[open_], ends[open_], listed[open_], part[:, open_]
    i, j = np.nonzero(part + _bound(tq, ty[rows], ends) >= least[:, None])
    j = rows[j]
    found = [np.zeros(0)]
    for lo in range(0, len(i), 1 << 16):
        found.append(np.einsum("ij,ij->i", q[i[lo:lo + (1 << 16)]], y[j[lo:lo + (1 << 16)]]))
    score = np.concatenate(found)
    good = score >= least[i]
    return i[good], j[good], score[good].astype(np.int64)


def _bound(tq: np.ndarray, ty: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What dimensions beyond each row's step can still add, for every anchor."""
    return tq[:, at] * ty[np.arange(len(at)), at][None, :] + 1e-6


def _first(group: np.ndarray, k: int) -> np.ndarray:
    """Which of the sorted group numbers are among the first k of their group."""
    new = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, int)
    size = np.diff(np.append(new, len(group)))
    return np.arange(len(group)) - np.repeat(new, size) < k


_FOUND = "anchor long, w int, rid long, id long, score long"


def _cell(order: np.ndarray, k: int, same: bool):
    """One block of anchors against one block of rows: for each window the first k rows above its threshold."""
    def run(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 5), np.int64)]
        if len(asked) and len(rows):
            y = _whole(rows["vec"].tolist(), len(order))[:, order]
            ids, rids, labels = (rows[c].to_numpy() for c in ("id", "rid", "label"))
            asked = asked.assign(_t=[min(w["t"] for w in ws) for ws in asked["windows"]]).sort_values("_t", kind="stable")
            for lo in range(0, len(asked), TOGETHER):
                part = asked.iloc[lo:lo + TOGETHER]
                q = _whole(part["vec"].tolist(), len(order))[:, order]
                i, j, score = reaching(q, y, part["_t"].to_numpy(np.float64))
                own, kind = part["rid"].to_numpy(), part["label"].to_numpy()
                able = (own[i] != rids[j]) if same else (kind[i] != labels[j])
                i, j, score = i[able], j[able], score[able]
                sort = np.lexsort((rids[j], ids[j], -score, i))
                i, j, score = i[sort], j[sort], score[sort]
                most = max(len(ws) for ws in part["windows"])
                number, low, high = np.zeros((3, len(part), most), np.int64)
                low[:], high[:] = 1, 0
                for r, ws in enumerate(part["windows"]):
                    for c, w in enumerate(ws):
                        number[r, c], low[r, c], high[r, c] = w["w"], w["t"], w["hi"]
                for c in range(most):
                    inside = np.flatnonzero((score >= low[i, c]) & (score <= high[i, c]))
                    hit = inside[_first(i[inside], k)]
                    out.append(np.column_stack([own[i[hit]], number[i[hit], c], rids[j[hit]], ids[j[hit]], score[hit]]))
        found = pd.DataFrame(np.concatenate(out), columns=["anchor", "w", "rid", "id", "score"])
        return found.astype({"w": np.int32})

    return run


_WINDOWS = "array<struct<w:int,lo:long,hi:long,t:long>>"
_WINDOW_TYPE = pa.list_(pa.struct([("w", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("t", pa.int64())]))


def _guess(shared, k: int, same: bool, times: int | None):
    """Sets each window's threshold where the sample has about ``times`` * k of all rows above; None: its whole range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = shared.value
        for batch in batches:
            asked = batch.to_pydict()
            for label, vec, windows in zip(asked["label"], asked["vec"], asked["windows"]):
                if times is None:
                    for w in windows:
                        w["t"] = w["lo"]
                    continue
                able = (sample["label"] == label) if same else (sample["label"] != label)
                pool = sample["sizes"].get(label, 0) if same else sample["total"] - sample["sizes"].get(label, 0)
                seen = int(able.sum())
                place = max(1, -(-times * k * seen // max(pool, 1)))
                score = np.sort(sample["y"][able] @ _whole([vec], sample["y"].shape[1])[0])[::-1]
                for w in windows:
                    fit = score[(score >= w["lo"]) & (score <= w["hi"])]
                    w["t"] = int(fit[place - 1]) if place <= len(fit) else w["lo"]
            at = batch.schema.names.index("windows")
            yield batch.set_column(at, "windows", pa.array(asked["windows"], _WINDOW_TYPE))

    return run


class _Rows:
    """The rows that take part, staged, with what all searches share: counts, and a bounded sample."""

    def __init__(self, df: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column):
        spark = df.sparkSession
        vec = named(df, vector_col).cast("array<double>")
        fit = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * SCALE) < float("inf")))
        rows = df.select(
            F.monotonically_increasing_id().alias("rid"), named(df, id_col).cast("bigint").alias("id"),
            named(df, label_col).cast("string").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), vec.alias("vec"), fit.alias("_fit"))
        self.rows = stage(rows.filter("id is not null and label is not null and _fit").drop("_fit"), "rows")
        self.sizes = stage(self.rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dims")), "sizes")
        whole = self.sizes.agg(F.sum("n").alias("n"), F.max("dims").alias("dims")).first()
        self.total, self.dims = int(whole["n"] or 0), max(1, int(whole["dims"] or 0))
        wanted = max(64, min(SAMPLE_ROWS, SAMPLE_NUMBERS // self.dims))
        # A bounded number of rows, by hash.
        picked = self.rows.select("label", "vec", F.xxhash64("rid").alias("_h")).orderBy("_h").limit(wanted).collect()
        y = _whole([r["vec"] for r in picked], self.dims)
        labels = np.array([r["label"] for r in picked], object)
        known = self.sizes.filter(F.col("label").isin(sorted(set(labels)))).collect() if picked else []
        self.order = np.argsort(-(y * y).sum(axis=0), kind="stable")
        self.shared = spark.sparkContext.broadcast(
            {"y": y, "label": labels, "total": self.total, "sizes": {r["label"]: r["n"] for r in known}})

    def search(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        """(anchor, w, rid, id, score): the first k rows of each window of ``asked`` (rid, label, vec, windows).

        Rows of the anchor's own label, itself left out, or with ``same`` False of any other label.
        """
        done, levels = [], [*GUESSES, None]
        schema = f"rid long, label string, vec array<double>, windows {_WINDOWS}"
        for n, times in enumerate(levels):
            asked = stage(asked.mapInArrow(_guess(self.shared, k, same, times), schema), "asked")
            found = stage(self._meet(asked, k, same), "found")
            best = Window.partitionBy("anchor", "w").orderBy(F.col("score").desc(), "id", "rid")
            found = stage(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "first")
            if n + 1 == len(levels):
                done.append(found)
                break
            filled = found.filter(F.col("rank") == k).select("anchor", "w")
            windows = asked.select("rid", F.inline("windows")).filter("t > lo")
            left = stage(windows.join(filled.withColumnRenamed("anchor", "rid"), ["rid", "w"], "left_anti"), "unfilled")
            if left.isEmpty():
                done.append(found)
                break
            done.append(found.join(left.select(F.col("rid").alias("anchor"), "w"), ["anchor", "w"], "left_anti"))
            # At most one window for each positive.
            again = left.groupBy("rid").agg(F.collect_list(F.struct("w", "lo", "hi", "t")).alias("windows"))
            asked = asked.drop("windows").join(again, "rid").select("rid", "label", "vec", "windows")
        return reduce(DataFrame.unionByName, done)

    def _meet(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        """Anchors and rows dealt to blocks; with ``same`` the blocks are cut within each label."""
        rows = self.rows.select("rid", "id", "label", "vec")
        keys = ["_a", "_r"]

        def blocks(n: Column, size: int, name: str) -> Column:
            return F.ceil(n / F.lit(size)).cast("int").alias(name)

        if same:
            counts = asked.groupBy("label").agg(F.count(F.lit(1)).alias("m")).join(self.sizes, "label")
            cuts = stage(counts.select("label", blocks(F.col("m"), BLOCK_ANCHORS, "a"), blocks(F.col("n"), BLOCK_ROWS, "r")), "cuts")
            asked, rows, keys = asked.join(cuts, "label"), rows.join(cuts, "label"), ["label", *keys]
        else:
            cut = [blocks(F.lit(n), size, name) for n, size, name in ((asked.count(), BLOCK_ANCHORS, "a"), (self.total, BLOCK_ROWS, "r"))]
            asked, rows = asked.select("*", *cut), rows.select("*", *cut)

        def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
            mine = F.pmod(F.xxhash64("rid"), F.greatest(F.col(own), F.lit(1))).cast("int")
            return df.withColumn(f"_{own}", mine).withColumn(
                f"_{other}", F.explode(F.sequence(F.lit(0), F.greatest(F.col(other), F.lit(1)) - 1))).drop("a", "r")

        left = dealt(asked, "a", "r").groupBy(*keys)
        return left.cogroup(dealt(rows, "r", "a").groupBy(*keys)).applyInPandas(_cell(self.order, k, same), _FOUND)


def hard_negatives(df: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows for which ``anchor`` holds. An anchor's positives are its first ``positives`` other rows of
    the same label, by score (the inner product of scaled, rounded-down components), then id. For each of them
    come the first ``negatives`` rows of another label that score from ``low`` to ``high`` percent of it; fewer where
    there are no more, none if the positive scores below 0.

    Rows with a NULL id or label, a NULL vector, or a NULL or non-finite component take no part. An empty vector is
    all zeros, a shorter one is followed by zeros. Repeated rows are rows of their own, so a repeated anchor has its copy
    among its positives and returns its rows again; scores beyond a bigint stop at 2^62. An empty table gives no
    rows; other columns are not read. The work is anchors times rows, dealt to tasks by blocks of both.
    """
    all_rows = _Rows(df, id_col, vector_col, label_col, anchor)
    anchors = stage(all_rows.rows.filter("anchor").select("rid", "id", "label", "vec"), "anchors")
    everything = F.array(F.struct(F.lit(0).alias("w"), F.lit(-FAR).alias("lo"), F.lit(FAR).alias("hi"), F.lit(-FAR).alias("t")))
    near = stage(all_rows.search(anchors.select("rid", "label", "vec", everything.alias("windows")), positives, True).select(
        "anchor", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    score = F.col("positive_score").cast("decimal(20,0)")
    span = F.struct("w", F.ceil(score * low / F.lit(100)).cast("bigint").alias("lo"), F.floor(score * high / F.lit(100)).cast("bigint").alias("hi"))
    # As many windows as an anchor has positives.
    windows = near.select("anchor", span.alias("s")).select("anchor", "s.*").filter("lo <= hi").groupBy(
        F.col("anchor").alias("rid")).agg(F.collect_list(F.struct("w", "lo", "hi", F.col("lo").alias("t"))).alias("windows"))
    asked = anchors.join(windows, "rid").select("rid", "label", "vec", "windows")
    mined = all_rows.search(asked, negatives, False)
    return mined.select("anchor", "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        near, ["anchor", "w"]).join(anchors.select(F.col("rid").alias("anchor"), F.col("id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
