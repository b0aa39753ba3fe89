"""Documents packed into sequences of bounded length by length patterns.

The number of pieces of each length is a histogram of at most ``capacity`` bars, whatever the size of the
corpus. Patterns of up to three lengths that fill a sequence exactly are enumerated, non-negative least
squares fits how often each is used so that the uses add up to the histogram, and the counts are rounded
without using a length more often than it occurs. What is left is packed by best fit on the histogram,
longest first. The plan says for the n-th piece of a length which sequence and place it takes, and pieces
look their place up by their rank within their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import pick
from lakewarden.llm.tokens import END_ID, encoder
from lakewarden.session import stage

CAPACITY = 2048
# Rows ranked together in one task.
SLICE_ROWS = 2_000
PIECES = "piece int, start long, length long, ids binary"


def _cutter(tokenizer: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, END_ID.to_bytes(4, "little")
        step = 4 * capacity
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                keys, pieces, starts, lengths, ids = [], [], [], [], []
                for row, text in enumerate(part.column(1).to_pylist()):
                    data = encode(text) + end
                    for n, at in enumerate(range(0, len(data), step)):
                        keys.append(row)
                        pieces.append(n)
                        starts.append(at // 4)
                        ids.append(data[at:at + step])
                        lengths.append(len(ids[-1]) // 4)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(keys, pa.int64())), pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()),
                ], names=["doc_id", "piece", "start", "length", "ids"])

    return cut


def token_pieces(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): each text's ids and a closing 0, cut only beyond ``capacity``."""
    rows = pick(df, id=id_col, text=text_col)
    return rows.mapInArrow(_cutter(tokenizer, capacity),
                           f"doc_id {rows.schema['id'].dataType.simpleString()}, {PIECES}")


# --- the plan, on the histogram ---

def full_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All ways to fill ``capacity`` with one, two or three of the lengths: rows of (a, b, c), a >= b >= c, 0 for none."""
    here = np.zeros(capacity + 1, bool)
    here[lengths] = True
    found = [np.array([[capacity, 0, 0]])] if here[capacity] else []
    a = lengths[lengths * 2 >= capacity]
    a = a[a < capacity]
    b = capacity - a
    pairs = here[b]
    found.append(np.stack([a[pairs], b[pairs], np.zeros(pairs.sum(), int)], axis=1))
    for first in lengths[(lengths * 3 >= capacity) & (lengths < capacity - 1)]:
        rest = capacity - first
        second = lengths[(lengths * 2 >= rest) & (lengths <= min(first, rest - 1))]
        third = rest - second
        second, third = second[here[third]], third[here[third]]
        found.append(np.stack([np.full(len(second), first), second, third], axis=1))
    return np.concatenate(found).astype(np.int64) if found else np.zeros((0, 3), np.int64)


def fit_counts(patterns: np.ndarray, bars: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Non-negative least squares: uses of each pattern whose lengths add up to ``bars``, by projected gradient.

    Nesterov's momentum, restarted where the error rises. Each bar is weighted by the tokens it stands for.
    """
    weight = np.arange(len(bars)) / (len(bars) - 1)
    used = (patterns > 0).astype(float)

    def forward(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(patterns[:, k], x * used[:, k], len(bars)) for k in range(3))
        return total * weight

    def back(r: np.ndarray) -> np.ndarray:
        r = r * weight
        return sum(r[patterns[:, k]] * used[:, k] for k in range(3))

    target = bars * weight
    probe = np.ones(len(patterns))
    for _ in range(20):  # the largest eigenvalue, for the step
        probe = back(forward(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    step = 1 / (1.05 * norm)
    x = y = np.zeros(len(patterns))
    t, last = 1.0, np.inf
    for _ in range(rounds):
        residual = forward(y) - target
        error = float(residual @ residual)
        new = np.maximum(0, y - step * back(residual))
        t_new = 1.0 if error > last else (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + ((t - 1) / t_new) * (new - x) if error <= last else new
        x, t, last = new, t_new, error
    return x


def plan_sequences(bars: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) for sequences that use each length ``n`` exactly ``bars[n]`` times."""
    capacity = len(bars) - 1
    left = bars.astype(np.int64).copy()
    plan: list[tuple[tuple[int, ...], int]] = []
    patterns = full_patterns(np.flatnonzero(left), capacity)
    if len(patterns):
        wanted = fit_counts(patterns, left.astype(float))
        # Rounded up in the order of the fitted counts, as far as the lengths last.
        for i in np.argsort(-wanted, kind="stable"):
            if wanted[i] < 1e-9:
                break
            lengths = tuple(int(n) for n in patterns[i] if n)
            times = min(int(np.ceil(wanted[i])), *(int(left[n]) // lengths.count(n) for n in lengths))
            if times > 0:
                plan.append((lengths, times))
                for n in lengths:
                    left[n] -= times
    # Best fit of the rest: open sequences by the room they have, in groups of equal make-up.
    rooms: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    open_rooms = np.zeros(capacity + 1, bool)
    for n in range(capacity, 0, -1):
        count = int(left[n])
        while count:
            fits = np.flatnonzero(open_rooms[n:])
            if len(fits):
                room = n + int(fits[0])
                made, times = rooms[room].pop()
                open_rooms[room] = bool(rooms[room])
                some = min(times, count)
                if some < times:
                    rooms[room].append((made, times - some))
                    open_rooms[room] = True
                rooms[room - n].append(((*made, n), some))
                open_rooms[room - n] = room > n
                count -= some
            else:
                each = capacity // n
                for many, times in ((each, count // each), (count % each, 1)):
                    if many and times:
                        rooms[capacity - many * n].append(((n,) * many, times))
                        open_rooms[capacity - many * n] = capacity > many * n
                count = 0
    return plan + [group for room in rooms for group in room]


def places(plan: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[str, np.ndarray]:
    """The plan as sorted arrays: which range of a length's ranks goes to which sequences and offset."""
    rows = []
    taken = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for lengths, times in plan:
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            each = lengths.count(n)
            rows.append((n, taken[n], each, sequence, offset))
            taken[n] += each * times
            offset += each * n
        sequence += times
    table = np.array(rows, np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    first = np.searchsorted(table[:, 0], np.arange(capacity + 2))
    return {"first": first, "rank": table[:, 1], "each": table[:, 2], "sequence": table[:, 3], "offset": table[:, 4]}


def _placer(shared):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("slot").to_numpy(zero_copy_only=False)
            row = np.empty(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                lo, hi = p["first"][n], p["first"][n + 1]
                row[own] = lo + np.searchsorted(p["rank"][lo:hi], rank[own], side="right") - 1
            nth = rank - p["rank"][row]
            sequence = p["sequence"][row] + nth // p["each"][row]
            offset = p["offset"][row] + nth % p["each"][row] * length
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "slot"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[n for n in batch.schema.names if n != "slot"] + ["sequence_id", "offset"])

    return place


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is between 1 and ``capacity``.

    ``pieces`` is read twice, so give a written table. Pieces of one length are interchangeable: which of
    them takes which place follows the hash of (doc_id, piece), and any order serves equal ones. A length
    that a third of all pieces share is ranked in slices by that hash, whose sizes are counted first.
    """
    spark = pieces.sparkSession
    # At most `capacity` rows, however large the corpus.
    bars = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        bars[row["length"]] = row["count"]
    shared = spark.sparkContext.broadcast(places(plan_sequences(bars), capacity))
    slices = int(bars.sum()) // slice_rows + 1
    order = F.xxhash64("doc_id", "piece")
    dealt = pieces.withColumn("_order", order).withColumn("_slice", F.pmod(F.col("_order"), F.lit(slices)))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint")).drop("_n")
    within = Window.partitionBy("length", "_slice").orderBy("_order")
    ranked = dealt.withColumn("_rank", F.row_number().over(within)).join(sizes, ["length", "_slice"])
    slots = ranked.select(*pieces.columns, (F.col("_rank") - 1 + F.col("_before")).cast("bigint").alias("slot"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return slots.mapInArrow(_placer(shared), f"{schema}, sequence_id long, offset long")


def pack_documents(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every text.

    NULL and empty texts are one piece that holds the closing id; NULL ids stay NULL; each repeated row is
    packed for itself, with the same piece numbers; an empty table gives no rows; other columns are not read.
    """
    pieces = stage(token_pieces(df, tokenizer, capacity, id_col, text_col), "pieces")
    return pack_pieces(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)


def fill_sequences(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from pieces whose (doc_id, piece) are unique."""
    parts = packed.select("doc_id", "piece", "sequence_id", "offset").join(
        pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    return parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts")).select(
        "sequence_id", F.aggregate("_parts", F.lit(b""), lambda out, p: F.concat(out, p["ids"])).alias("ids"))
