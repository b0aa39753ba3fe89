"""Near-duplicate texts by DartMinHash.

Each shingle of five words is an element with a weight. Darts are thrown at the plane of weight and rank by a hash
of the element and the region alone, so equal elements of different texts get the same darts; a text is hit by
the darts below its elements' weights. Rank strips are thrown in ascending order until every coordinate of the
signature has its earliest dart, which takes about k ln k darts however long the text is. Texts that agree in a
band of the signature are candidates, and candidates are compared on their exact shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import named
from lakewarden.llm.components import components
from lakewarden.operators.lineage import FILTER_BITS, held_in
from lakewarden.session import stage

SHINGLE = 5
SIMILARITY = 0.8
# A pair at the threshold shares none of 24 bands of 4 once in 300,000 times.
BANDS, BAND_ROWS = 24, 4
COORDINATES = BANDS * BAND_ROWS
# One-bit coordinates by which the members of a bucket that is still open are compared.
SHARP_BITS = 1024
SHARP = [f"w{i}" for i in range(SHARP_BITS // 64)]
# So many standard deviations below the threshold's agreement, signatures do not drop a candidate: at the threshold
# either test does once in some nine million times, so that the bands stay the weakest step.
DEVIATIONS = 5.5
# Bytes of text hashed together; arrays of that length bound a worker's memory.
CHUNK_BYTES = 2_000_000
# Members of an open bucket that one task compares with all of the bucket.
OPEN_ROWS = 4096
# Bits of the filter for each bucket that is asked for, up to ``FILTER_BITS`` in all.
BUCKET_BITS = 16
# Bitmaps of 32768 row numbers that are broadcast at most: 64 MB, which numbers some 500 million rows.
ROW_BITMAPS = 16384
# Height of the lowest rank strip; each next strip doubles the height reached.
FIRST_STRIP = 2.0 ** -7

_U = np.uint64
_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finalising hash of 64-bit numbers."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def row(base: int) -> np.ndarray:
        out = np.full(size, base, _U)
        out[0] = 1
        return np.multiply.accumulate(out)

    return row(_BASE), row(pow(_BASE, -1, 1 << 64))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word: differences of one running sum, brought to a common scale."""
    raw = np.frombuffer(data, np.uint8)
    word = np.concatenate([[False], (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D)), [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    start, end = edges[::2], edges[1::2]
    size = 1 << max(16, (len(raw) + 1).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * up[:len(raw)], out=total[1:])
    return _mixed((total[end] - total[start]) * down[start] + (end - start).astype(_U)), start


def _segments(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """Pieces of texts, long ones cut where a word ends, in groups of about ``CHUNK_BYTES``."""
    group, size = [], 0
    for n, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = min(len(text), at + CHUNK_BYTES)
            while end < len(text) and text[end] not in b" \t\n\x0b\f\r":
                end += 1
            group.append((n, text[at:end]))
            size += end - at
            at = end
            if size >= CHUNK_BYTES:
                yield group
                group, size = [], 0
    if group:
        yield group


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, how often) of all texts, sorted; fewer than five words are one shingle."""
    words, owner = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    for group in _segments([(t or "").encode() for t in texts]):
        lengths = np.array([len(s) + 1 for _, s in group])
        hashes, start = _word_hashes(b"\n".join(s for _, s in group))
        words.append(hashes)
        segment = np.searchsorted(np.cumsum(lengths), start, side="right")
        owner.append(np.array([n for n, _ in group])[segment])
    w, d = np.concatenate(words), np.concatenate(owner)
    n = max(len(w) - SHINGLE + 1, 0)
    inside = d[:n] == d[SHINGLE - 1:] if n else np.zeros(0, bool)
    value = np.zeros(n, _U)
    for k in range(SHINGLE):
        value = _mixed(value * _U(0x2545F4914F6CDD1D) + w[k:n + k])
    value, of = value[inside], d[:n][inside]
    ids, counts = np.unique(d, return_counts=True)
    few = ids[counts < SHINGLE]
    if len(few):
        first = np.searchsorted(d, few)
        short = np.zeros(len(few), _U)
        for k in range(SHINGLE - 1):
            has = counts[counts < SHINGLE] > k
            short[has] = _mixed(short[has] * _U(0x2545F4914F6CDD1D) + w[first[has] + k] + _U(1))
        value, of = np.concatenate([value, short]), np.concatenate([of, few])
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return of[at], value[at], np.diff(np.append(at, len(value)))


@lru_cache(maxsize=64)
def _poisson(area: float) -> np.ndarray:
    """Cumulative chances of 0, 1, ... darts in a region."""
    most = int(area + 12 * np.sqrt(area) + 24)
    log = -area + np.concatenate([[0.0], np.cumsum(np.log(area / np.arange(1, most + 1)))])
    return np.minimum(np.cumsum(np.exp(log)), 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0 ** -53


def signatures(of: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int = COORDINATES) -> np.ndarray:
    """The earliest dart per coordinate for each of ``n`` texts, 0 in texts without elements.

    Two texts agree in a coordinate with the chance of their weighted Jaccard similarity.
    """
    out = np.zeros((n, k), _U)
    missing = np.bincount(of, minlength=n) > 0
    missing = np.where(missing, k, 0)
    weight = weight.astype(np.float64)
    low, high, strip = 0.0, FIRST_STRIP, 0
    while missing.any():
        here = missing[of] > 0
        of, element, weight = of[here], element[here], weight[here]
        owners, coordinates, ranks, darts = [], [], [], []
        level, w_low, w_high = 0, 0.0, 1.0
        while True:
            in_level = np.flatnonzero(weight > w_low)
            if not len(in_level):
                break
            seed = _mixed(element[in_level] + _U((strip * 64 + level + 1) * 0x9FB21C651E98DF25 % (1 << 64)))
            count = np.searchsorted(_poisson((w_high - w_low) * (high - low)), _unit(seed), side="right")
            hit = np.flatnonzero(count)
            row = np.repeat(hit, count[hit])
            number = np.arange(len(row)) - np.repeat(np.cumsum(count[hit]) - count[hit], count[hit])
            dart = _mixed(seed[row] + (number.astype(_U) + _U(1)) * _U(0xA0761D6478BD642F))
            height = w_low + (w_high - w_low) * _unit(_mixed(dart ^ _U(0x8EBC6AF09C88C6E3)))
            below = height < weight[in_level[row]]
            dart, row = dart[below], in_level[row[below]]
            owners.append(of[row])
            coordinates.append((_mixed(dart ^ _U(0x589965CC75374CC3)) % _U(k)).astype(np.int64))
            ranks.append(low + (high - low) * _unit(_mixed(dart ^ _U(0x1D8E4E27C47D124F))))
            darts.append(dart)
            level, w_low, w_high = level + 1, w_high, w_high * 2
        owner, place, rank, dart = (np.concatenate(x) for x in (owners, coordinates, ranks, darts))
        cell = owner * k + place
        order = np.lexsort((dart, rank, cell))
        cell, dart = cell[order], dart[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        cell, dart = cell[first], dart[first]
        free = out.reshape(-1)[cell] == 0
        out.reshape(-1)[cell[free]] = dart[free] | _U(1)
        missing = missing - np.bincount(cell[free] // k, minlength=n)
        low, high, strip = high, high * 2, strip + 1
    return out


def _sliced(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose hashing fits in a bounded amount of memory."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK_BYTES or i + 1 == len(texts):
            yield lo, i + 1
            lo, size = i + 1, 0


def _signer(weighted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _sliced(texts):
                n = hi - lo
                of, element, weight = shingles(texts[lo:hi])
                if not weighted:
                    weight = np.ones(len(element))
                found = signatures(of, element, weight, n)
                sizes = np.bincount(of, weights=weight, minlength=n).astype(np.int64)
                keys = [np.zeros(n, _U), np.zeros(n, _U)]
                for i, salt in enumerate((0x71D67FFFEDA60000, 0xFFF7EEE000000000)):
                    np.add.at(keys[i], of, _mixed(element + _U(salt) + weight.astype(_U)))
                bands = np.zeros((n, BANDS), _U)
                for r in range(BAND_ROWS):
                    bands = _mixed(bands * _U(0x2545F4914F6CDD1D) + found[:, r::BAND_ROWS])
                marks = (found >> _U(1)).astype(np.uint16).view(np.int16)

                def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
                    flat = pa.array(values.reshape(-1), kind)
                    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * values.shape[1], pa.int32()), flat)

                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, n), pa.array(sizes),
                    pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
                    lists(bands.view(np.int64), pa.int64()), lists(marks, pa.int16()),
                ], names=["rid", "size", "key1", "key2", "bands", "marks"])

    return run


def _elements(of: np.ndarray, element: np.ndarray, weight: np.ndarray, weighted: bool, n: int) -> pa.Array:
    """Each text's shingles as a set of numbers; with weights the second, third, ... use of one are elements of their own."""
    if weighted:
        use = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
        of = np.repeat(of, weight)
        element = _mixed(np.repeat(element, weight) + use.astype(_U) * _U(0xA0761D6478BD642F))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32()), pa.array(element.view(np.int64)))


def _sets(weighted: bool):
    """The number and the elements of each text, and the columns that follow the text as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _sliced(texts):
                elements = _elements(*shingles(texts[lo:hi]), weighted, hi - lo)
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), elements, *own.columns[2:]], names=["node", "elements", *own.schema.names[2:]])

    return run


def _sharp(weighted: bool):
    """One bit of each of many more coordinates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _sliced(texts):
                of, element, weight = shingles(texts[lo:hi])
                weight = weight if weighted else np.ones(len(element))
                words = []
                for at in range(0, hi - lo, 64):
                    here = (of >= at) & (of < at + 64)
                    n = min(64, hi - lo - at)
                    found = signatures(of[here] - at, element[here], weight[here], n, SHARP_BITS)
                    words.append(np.packbits(((found >> _U(1)) & _U(1)).astype(np.uint8), axis=1).view(np.int64))
                bits = np.concatenate(words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *[pa.array(bits[:, k]) for k in range(bits.shape[1])]],
                    names=["node", *SHARP])

    return run


def _alike(both: Column, a: Column, b: Column, similarity: float) -> Column:
    """Sets of ``a`` and ``b`` elements that have ``both`` in common reach the threshold, in whole numbers."""
    share = round(similarity * 1000)
    return 1000 * both >= share * (a + b - both)


def _only(df: DataFrame, key: str, ids: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` whose row number ``key`` is in the one column of ``ids``.

    The numbers are kept as one bit each and looked up where rows are read, so neither texts nor signatures are shuffled
    to be dropped. Only beyond ``ROW_BITMAPS`` of them does it become a join.
    """
    ids = ids.toDF(key)
    bits = stage(ids.groupBy(F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bitmap")), label)
    if not bits.offset(ROW_BITMAPS).isEmpty():
        return df.join(ids.distinct(), key, "left_semi")
    return held_in(df, F.bitmap_bucket_number(key), F.bitmap_bit_position(key), bits)


def _in_buckets(banded: DataFrame, buckets: DataFrame) -> DataFrame:
    """The members of the buckets: most of the others go by a filter of hashed buckets before the shuffle."""
    size = min(FILTER_BITS, 1 << max(15, (BUCKET_BITS * buckets.count()).bit_length()))
    place = F.pmod(F.xxhash64("band", "key"), F.lit(size)) + 1
    bits = stage(buckets.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")), "bucket_bits")
    return held_in(banded, F.bitmap_bucket_number(place), F.bitmap_bit_position(place), bits).join(buckets, ["band", "key"])


def _compared(pairs: DataFrame, texts: DataFrame, weighted: bool, similarity: float) -> DataFrame:
    """(node, hub, linked, plus, minus) of each pair (node, hub, centred); the last two, what the node has more than
    the hub and what it lacks, only where the hub is the middle of a bucket of the node, else NULL.

    A node's text meets its hubs' numbers, at most two for each band, before it becomes a set. The set then travels
    to the hubs, not the hub's to all of its nodes, and both are compared once for all that is asked of them.
    """
    hubs = pairs.groupBy(F.col("node").alias("rid")).agg(F.collect_list(F.struct("hub", "centred")).alias("hubs"))
    of_nodes = _only(texts, "rid", pairs.select("node"), "asked_nodes").join(hubs, "rid").select("rid", "_text", "hubs").mapInArrow(
        _sets(weighted), "node long, elements array<long>, hubs array<struct<hub: long, centred: boolean>>")
    of_hubs = _only(texts, "rid", pairs.select("hub"), "asked_hubs").select("rid", "_text").mapInArrow(
        _sets(weighted), "node long, elements array<long>").toDF("hub", "_eh")
    met = of_nodes.select("node", F.col("elements").alias("_en"), F.inline("hubs")).join(of_hubs, "hub")
    both = F.size(F.array_intersect("_en", "_eh"))
    return met.select(
        "node", "hub", _alike(both, F.size("_en"), F.size("_eh"), similarity).alias("linked"),
        F.when(F.col("centred"), F.array_except("_en", "_eh")).alias("plus"),
        F.when(F.col("centred"), F.array_except("_eh", "_en")).alias("minus"))


def _sizes_allow(a: str, b: str, similarity: float) -> Column:
    share = round(similarity * 1000)
    return (1000 * F.col(f"{a}.size") >= share * F.col(f"{b}.size")) & (1000 * F.col(f"{b}.size") >= share * F.col(f"{a}.size"))


def _may_match(a: str, b: str, similarity: float) -> Column:
    """Sizes allow the threshold, and the signatures agree in no fewer than ``DEVIATIONS`` below it."""
    least = int(COORDINATES * similarity - DEVIATIONS * (COORDINATES * similarity * (1 - similarity)) ** 0.5)
    agree = F.aggregate(F.zip_with(F.col(f"{a}.marks"), F.col(f"{b}.marks"), lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return _sizes_allow(a, b, similarity) & (agree >= least)


def _sharply_alike(a: str, b: str, similarity: float) -> Column:
    """The same on bits: those of unlike coordinates agree by chance in one of two cases."""
    same = (1 + similarity) / 2
    most = SHARP_BITS * (1 - same) + DEVIATIONS * (SHARP_BITS * same * (1 - same)) ** 0.5
    unlike = sum((F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))) for w in SHARP), F.lit(0))
    return _sizes_allow(a, b, similarity) & (unlike <= int(most))


def _first_shared(a: str, b: str, band: Column) -> Column:
    """A pair is met in the first of the bands that it shares, and in no other."""
    return F.array_position(F.zip_with(a, b, lambda x, y: x == y), True) == band + 1


def _distinct_buckets(members: DataFrame) -> DataFrame:
    """The members of one bucket, that of the lowest band, for each set of nodes that buckets of several bands hold.

    Near copies share many bands, so most of their buckets hold the same nodes and need to be compared once. A pair's
    first shared band stays: a bucket of the same nodes in a lower band would be shared by the pair as well. Sets
    are told apart by their size and two XORs of 64-bit hashes, reduced per task before the shuffle.
    """
    marked = members.groupBy("band", "key", "n").agg(
        F.bit_xor(F.xxhash64("node")).alias("_x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("_y"))
    lowest = marked.groupBy("n", "_x", "_y").agg(F.min(F.struct("band", "key")).alias("_b")).select("_b.*")
    return members.join(stage(lowest, "distinct_buckets"), ["band", "key"], "left_semi")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                    similarity: float = SIMILARITY, weighted: bool = False) -> DataFrame:
    """``_row`` (the columns of ``df``, or those to ``carry``), ``class_id``, ``class_size`` and ``kept`` per row.

    A class is what links of at least ``similarity`` connect; its id is its smallest document id and the row that
    has it is kept. Weights are 1, which gives the Jaccard similarity of shingle sets, or with ``weighted``
    the counts of the shingles. Texts of the same shingles are one node from the start. Every band's bucket is
    first compared with its smallest and its largest member; then members of one bucket that are still in
    different classes are compared with each other inside a join, so no candidate link between classes is lost while
    links inside a class are not listed. A NULL, empty or blank text is alone in its class; fewer than five words are
    one shingle; NULL ids come after all others; of repeated rows one is kept; an empty table gives no
    rows; names cannot clash, as the columns stay in ``_row``.
    """
    kept = df.columns if carry is None else carry
    row = F.struct(*[named(df, c) for c in kept]).alias("_row")
    own = [] if text_col in kept else [named(df, text_col).alias("_text")]
    rows = stage(df.select(F.monotonically_increasing_id().alias("rid"), row, named(df, id_col).alias("id"), *own), "texts")
    texts = rows.select("rid", F.col("_text") if own else F.col("_row").getField(text_col).alias("_text"))
    signed = stage(texts.mapInArrow(
        _signer(weighted), "rid long, size long, key1 long, key2 long, bands array<long>, marks array<short>"), "signed")
    some = signed.filter("size > 0")
    nodes = stage(some.groupBy("key1", "key2").agg(F.min("rid").alias("node")), "nodes")
    of_node = stage(some.select("rid", "size", "key1", "key2").join(nodes, ["key1", "key2"]).select("rid", "node"), "of_node")
    reps = _only(some, "rid", nodes.select("node"), "node_bits").select(F.col("rid").alias("node"), "size", "bands", "marks")
    banded = reps.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = stage(banded.groupBy("band", "key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).filter(
        "n > 1"), "buckets")
    shared = stage(_distinct_buckets(stage(_in_buckets(banded, buckets), "members")), "shared")
    # The middle of a group meets more of it than its fringe does. Of two nodes the same one is the middle in every bucket.
    reach = stage(shared.groupBy("node").agg(F.sum("n").alias("reach")), "reach")
    middle = stage(shared.select("band", "key", "node").join(reach, "node").groupBy("band", "key").agg(
        F.max_by("node", F.struct("reach", "node")).alias("middle")), "middles")
    stars = shared.select("band", "key", "node", "first").join(middle, ["band", "key"]).select("node", F.explode(F.array(
        F.struct(F.col("middle").alias("hub"), F.lit(True).alias("centred")),
        F.struct(F.col("first").alias("hub"), F.lit(False).alias("centred")))).alias("to")).select("node", "to.*")
    # Two nodes meet once, whichever is the other's hub.
    pairs = stage(stars.filter("node <> hub").groupBy(F.least("node", "hub"), F.greatest("node", "hub")).agg(
        F.max(F.struct("centred", "node", "hub")).alias("to")).select("to.*"), "pairs")
    fringe = pairs.filter("not centred")
    ends = fringe.select("node").unionByName(fringe.select(F.col("hub").alias("node")))
    known = _only(reps, "node", ends, "fringe_bits").select("node", F.struct("node", "size", "marks").alias("s"))
    likely = fringe.join(known.select("node", F.col("s").alias("sn")), "node").join(
        known.select(F.col("node").alias("hub"), F.col("s").alias("sh")), "hub").filter(_may_match("sn", "sh", similarity))
    asked = stage(pairs.filter("centred").unionByName(likely.select("centred", "node", "hub")), "asked")
    compared = stage(_compared(asked, texts, weighted, similarity), "compared")
    found = components(compared.filter("linked").select(F.col("node").alias("a"), F.col("hub").alias("b")))
    merged = components(_across(texts, reps, shared, middle, compared, found, weighted, similarity))
    return rows.select("rid", "_row").join(_classes(rows.select("rid", "id"), of_node, found, merged), "rid").drop("rid")


def _across(texts: DataFrame, reps: DataFrame, shared: DataFrame, middle: DataFrame, compared: DataFrame, found: DataFrame,
            weighted: bool, similarity: float) -> DataFrame:
    """(a, b): classes with a link between members of one bucket, found on all pairs of members of different classes.

    Each member is held as its difference to the middle of its bucket: what it has more, and what it lacks. For
    near-copies both are short, and the size of an intersection follows from the differences of two members, so the
    exact comparison is made inside the join. Its work is quadratic in the unlinked members of a bucket, in chunks
    of at most ``OPEN_ROWS`` of them a task; its rows are true links, reduced to classes before they leave it. Buckets of
    one chunk are joined with themselves, so their members are shuffled once for both sides.
    """
    placed = stage(shared.select("band", "key", "node").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")), "placed")
    split = placed.groupBy("band", "key").agg(
        F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count(F.lit(1)).alias("n")).filter("_lo <> _hi")
    unsettled = stage(placed.join(split.select("band", "key", "n"), ["band", "key"]).join(middle, ["band", "key"]), "unsettled")
    wanted = stage(unsettled.select("node").distinct(), "wanted")
    bits = _only(texts, "rid", wanted, "wanted_texts").select("rid", "_text").mapInArrow(
        _sharp(weighted), "node long, " + ", ".join(f"{w} long" for w in SHARP))
    known = _only(reps, "node", wanted, "wanted_nodes").select("node", "size", "bands")
    marks = bits.join(known, "node").select("node", F.struct("node", "size", "bands", *SHARP).alias("s"))
    # Few middles for each member, however many buckets it is in.
    none = F.array().cast("array<long>")
    differences = compared.filter("plus is not null").select("node", F.col("hub").alias("middle"), "plus", "minus").unionByName(
        unsettled.filter("node = middle").select("node", "middle").distinct().select("node", "middle", none.alias("plus"), none.alias("minus")))
    # Middles are compared beside the join's key, so that all three are dealt out by node, once.
    placed_in = unsettled.withColumnRenamed("middle", "own_middle")
    open_ = stage(differences.join(marks, "node").join(placed_in, "node").filter(F.col("middle") - F.col("own_middle") == 0).select(
        "band", "key", "component", "s", "plus", "minus", F.ceil(F.col("n") / F.lit(OPEN_ROWS)).cast("int").alias("chunks")), "open")
    whole, parts = open_.filter("chunks = 1").drop("chunks"), open_.filter("chunks > 1")
    x = parts.withColumn("chunk", F.pmod(F.xxhash64("s.node"), F.col("chunks")).cast("int"))
    y = parts.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = _linked(whole, whole, ["band", "key"], similarity).unionByName(_linked(x, y, ["band", "key", "chunk"], similarity))
    return stage(met.distinct(), "across")


def _linked(x: DataFrame, y: DataFrame, on: list[str], similarity: float) -> DataFrame:
    """(a, b): components of members that meet and reach the threshold; x has the smaller one."""
    size = F.col("x.s.size") - F.size("x.plus") + F.size("x.minus")  # of the middle
    both = size - F.size(F.array_union("x.minus", "y.minus")) + F.size(F.array_intersect("x.plus", "y.plus"))
    test = (F.col("x.component") < F.col("y.component")) & _sharply_alike("x.s", "y.s", similarity) & _first_shared(
        "x.s.bands", "y.s.bands", F.col("x.band")) & _alike(both, F.col("x.s.size"), F.col("y.s.size"), similarity)
    for c in on:
        test = test & (F.col(f"x.{c}") == F.col(f"y.{c}"))
    return x.alias("x").join(y.alias("y"), test).select(F.col("x.component").alias("a"), F.col("y.component").alias("b"))


def _classes(rows: DataFrame, of_node: DataFrame, found: DataFrame, merged: DataFrame) -> DataFrame:
    """(rid, class_id, class_size, kept): a row's class is that of its node's component, or else the row itself."""
    own = rows.join(of_node, "rid", "left").join(found, "node", "left").select(
        "rid", "id", F.coalesce("component", "node", "rid").alias("node"))
    classed = stage(own.join(merged, "node", "left").select("rid", "id", F.coalesce("component", "node").alias("class")), "classed")
    # The smallest id, NULLs last, and of the rows that have it the first one.
    facts = stage(classed.groupBy("class").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("_first"), F.count(F.lit(1)).alias("class_size")).select(
        "class", F.col("_first.id").alias("class_id"), "class_size", F.col("_first.rid").alias("owner")), "facts")
    return classed.join(facts, "class").select(
        "rid", "class_id", "class_size", (F.col("rid") == F.col("owner")).alias("kept"))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with the columns of ``df``."""
    return near_duplicates(df, id_col, text_col).filter("kept").select("_row.*")
