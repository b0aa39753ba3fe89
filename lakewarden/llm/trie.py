"""The prefix trie of conversations by ROLLUP.

A turn is reduced to an id, the hash of its role and text. The turns of a conversation lie side by side in ``WIDTH``
columns, and one ``GROUP BY ... ROLLUP`` over these columns aggregates all prefixes of a block together, told
apart by ``grouping_id``. Longer conversations go on in further blocks of columns, grouped under the node that
the block before ended in. That node is known by a digest of the turns so far, an XOR of hashes that carry
their position, so the blocks of all depths are rolled up in one aggregate and no step waits for a shallower one.

A node is (its smallest member, its depth). The nodes that one conversation is the smallest member of form a path
down to the conversation's end, and each node lies on one path. What a subtree holds is therefore a sum over a
node's members alone: their texts, less what each of them adds to the trie as a path of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import named
from lakewarden.session import stage

# Turns side by side in one block.
WIDTH = 8
# Blocks of one conversation whose digests are added up in one task.
SPAN = 1024
# Ids of one range of this many numbers are joined to one piece of text before they are digested.
ID_BITS = 12

_BEFORE = (Window.unboundedPreceding, -1)


def _half(digest: str, start: int) -> Column:
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")


def turns_of(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, pos, hi, lo, bytes): place from 0, id in two halves and length in bytes of every turn.

    Turns are ordered by number, NULL first, equal numbers by role and text, so repeated rows are turns of their
    own. A NULL role or text is empty; rows without a conversation id are left out. Rows are sorted by range, so
    a conversation of any length is spread over tasks; only row counts per task are added up.
    """
    def text(c: str) -> Column:
        return F.coalesce(named(df, c).cast("string"), F.lit(""))

    rows = df.select(named(df, id_col).cast("bigint").alias("conv"), named(df, turn_col).alias("turn"),
                     text(role_col).alias("role"), text(text_col).alias("text")).filter("conv is not null")
    order = ["conv", F.col("turn").asc_nulls_first(), "role"]
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    key = F.concat_ws(":", F.octet_length("role"), F.concat("role", "text"))
    placed = stage(dealt.select(
        F.monotonically_increasing_id().alias("rid"), "conv", F.md5(key.cast("binary")).alias("digest"),
        F.octet_length("text").cast("bigint").alias("bytes")).select(
        "rid", F.call_function("shiftright", F.col("rid"), F.lit(33)).alias("part"), "conv",
        _half("digest", 1).alias("hi"), _half("digest", 17).alias("lo"), "bytes"), "turns")
    parts = placed.groupBy("conv", "part").agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(*_BEFORE)), F.lit(0)))
    return placed.join(parts.drop("n"), ["conv", "part"]).select(
        "conv", (F.col("rid") - F.col("first") + F.col("before")).alias("pos"), "hi", "lo", "bytes")


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) where each conversation c begins like the first of its group, c - c % ``group``.

    It takes the first h turns of that one (all if it has fewer, none if there is none), then its own after its
    first h, with h = crc32 of c's decimal text modulo ``heads``. A conversation may be left without turns.
    """
    turns = stage(turns, "numbered")
    sizes = stage(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "sizes")
    plan = sizes.select("conv", (F.col("conv") - F.col("conv") % group).alias("base"),
                        (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).alias("h"))
    plan = stage(plan.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base")), "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("lead")), "plan")
    own = turns.join(plan.select("conv", "h", "lead"), "conv").filter("pos >= h").withColumn(
        "pos", F.col("pos") - F.col("h") + F.col("lead")).select(turns.columns)
    lent = turns.filter(F.col("pos") < heads - 1).withColumnRenamed("conv", "base").join(
        plan.select("conv", "base", "lead"), "base").filter("pos < lead").select(turns.columns)
    return stage(own.unionByName(lent), "rebuilt"), sizes.select("conv")


def _marks(pos: Column, hi: Column, lo: Column) -> tuple[Column, Column]:
    """Two hashes of a turn at its place; their XOR over a prefix is the digest of the prefix."""
    return F.xxhash64(F.lit(1), pos, hi, lo), F.xxhash64(F.lit(2), hi, pos, lo)


def _blocks(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, ends): each conversation's turns in rows of ``WIDTH``, with what lies before; and its whole digest."""
    x1, x2 = _marks(F.col("pos"), F.col("hi"), F.col("lo"))
    cells = turns.select("conv", F.floor(F.col("pos") / WIDTH).cast("bigint").alias("block"), (F.col("pos") % WIDTH).alias("at"),
                         "hi", "lo", "bytes", x1.alias("x1"), x2.alias("x2"))
    wide = [F.max(F.when(F.col("at") == k, F.col(c))).alias(f"{c}{k}") for k in range(WIDTH) for c in ("hi", "lo", "bytes")]
    sums = [F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")]
    rows = stage(cells.groupBy("conv", "block").agg(
        *sums, F.sum("bytes").alias("total"), F.count(F.lit(1)).alias("n"), *wide), "blocks")

    def before(over) -> list[Column]:
        return [F.coalesce(f(c).over(over), F.lit(0).cast("bigint")).alias(p)
                for f, c, p in ((F.bit_xor, "x1", "p1"), (F.bit_xor, "x2", "p2"), (F.sum, "total", "passed"))]

    span = F.floor(F.col("block") / SPAN).cast("bigint").alias("span")
    local = rows.select("*", span).select("*", *before(Window.partitionBy("conv", "span").orderBy("block").rowsBetween(*_BEFORE)))
    # Spans beyond the first occur only in very long conversations.
    long = rows.filter(F.col("block") >= SPAN).select("conv").distinct()
    spans = rows.join(long, "conv", "left_semi").select("*", span).groupBy("conv", "span").agg(*sums, F.sum("total").alias("total"))
    ahead = spans.select("conv", "span", *before(Window.partitionBy("conv").orderBy("span").rowsBetween(*_BEFORE))).filter(
        "span > 0").toDF("conv", "span", "q1", "q2", "more")
    ahead = stage(ahead, "spans")
    ids = [F.when(F.col(f"hi{k}").isNotNull(), F.struct(
        F.col(f"hi{k}").alias("hi"), F.col(f"lo{k}").alias("lo"), F.col(f"bytes{k}").alias("bytes"))).alias(f"t{k}") for k in range(WIDTH)]
    none = F.lit(0).cast("bigint")
    full = local.join(ahead, ["conv", "span"], "left").select(
        "conv", "block", F.col("p1").bitwiseXOR(F.coalesce("q1", none)).alias("p1"),
        F.col("p2").bitwiseXOR(F.coalesce("q2", none)).alias("p2"), (F.col("passed") + F.coalesce("more", none)).alias("passed"), *ids)
    ends = rows.groupBy("conv").agg(F.sum("n").alias("depth"), F.sum("total").alias("total"), *sums)
    bare = conversations.join(ends.select("conv"), "conv", "left_anti")
    ends = ends.unionByName(bare.select("conv", *[none.alias(c) for c in ("depth", "total", "x1", "x2")]))
    empty = bare.select("conv", *[none.alias(c) for c in ("block", "p1", "p2", "passed")], *[
        F.lit(None).cast(full.schema[f"t{k}"].dataType).alias(f"t{k}") for k in range(WIDTH)])
    return stage(full.unionByName(empty), "rows"), stage(ends, "ends")


def _rolled(rows: DataFrame, *sums: str) -> DataFrame:
    """One row per node: depth, smallest member ``conv``, the sums, its text's ``bytes``, digests of itself and its parent.

    ``passed`` is the bytes of the turns above it. A level whose last turn is missing is no prefix; the level
    without any turn is the root in the first block and the node of the block before in the others.
    """
    columns = ", ".join(f"t{k}" for k in range(WIDTH))
    grouped = rows.sparkSession.sql(f"""
        SELECT block, p1, p2, passed, {columns}, {WIDTH} - bit_count(grouping_id()) AS level, min(conv) AS conv,
               count(*) AS n_convs {''.join(f', sum({c}) AS {c}' for c in sums)}
        FROM {{rows}} GROUP BY block, p1, p2, passed, ROLLUP ({columns})""", rows=rows)
    level = F.col("level")
    last = reduce(lambda other, k: F.when(level == k + 1, F.col(f"t{k}")).otherwise(other), range(WIDTH), F.lit(None))
    nodes = grouped.withColumn("last", last).filter(F.col("last").isNotNull() | ((level == 0) & (F.col("block") == 0)))
    depth = F.col("block") * WIDTH + level
    above = [F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.lit(0).cast("bigint")]
    for k in range(WIDTH):
        t = F.col(f"t{k}")
        parts = (*_marks(F.col("block") * WIDTH + k, t["hi"], t["lo"]), t["bytes"])
        above = [a.bitwiseXOR(F.when(level > k + 1, m).otherwise(0)) if i < 2 else a + F.when(level > k + 1, m).otherwise(0)
                 for i, (a, m) in enumerate(zip(above, parts))]
    m1, m2 = (F.when(level > 0, m).otherwise(0) for m in _marks(depth - 1, F.col("last.hi"), F.col("last.lo")))
    nodes = nodes.select(
        depth.alias("depth"), "conv", "n_convs", *sums, F.coalesce("last.bytes", F.lit(0)).cast("bigint").alias("bytes"),
        (F.col("passed") + above[2]).alias("passed"), F.col("p1").bitwiseXOR(above[0]).alias("e1"),
        F.col("p2").bitwiseXOR(above[1]).alias("e2"), m1.alias("m1"), m2.alias("m2"))
    return nodes.withColumn("d1", F.col("e1").bitwiseXOR(F.col("m1"))).withColumn("d2", F.col("e2").bitwiseXOR(F.col("m2"))).drop("m1", "m2")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each node, which come in order; only one digest is held."""
    now, digest = None, hashlib.sha256()
    names = ["conv", "depth", "ends_sha256"]
    for batch in batches:
        done: tuple[list, list, list] = ([], [], [])
        for conv, depth, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (conv, depth) == now:
                digest.update(b",")
            else:
                if now is not None:
                    for column, value in zip(done, (*now, digest.hexdigest())):
                        column.append(value)
                now, digest = (conv, depth), hashlib.sha256()
            digest.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.int64()), pa.array(done[1], pa.int64()), pa.array(done[2], pa.string())], names=names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([digest.hexdigest()])], names=names)


def _end_digests(members: DataFrame) -> DataFrame:
    """(conv, depth, ends_sha256) from (conv, depth, member): ids of one range are joined first, then digested in order."""
    piece = F.call_function("shiftright", F.col("member"), F.lit(ID_BITS)).alias("piece")
    joined = members.groupBy("conv", "depth", piece).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("member")), lambda m: m.cast("string")), ",").alias("ids"))
    dealt = joined.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "piece")
    return dealt.select("conv", "depth", "ids").mapInArrow(_digested, "conv long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` is (conv, pos, hi, lo, bytes) as ``turns_of`` makes it, ``conversations`` (conv) all of them, those
    without a turn too; these belong to the root alone. A node is known by its smallest member and its depth.
    ``saved_tokens`` adds, over the subtree, (members - 1) times the bytes of the node's text; ``ends_sha256``
    digests the ids of the members that end there. No conversations give no nodes. Work grows with turns times
    ``WIDTH``; members of one node are counted per task before the shuffle, however many they are.
    """
    rows, ends = _blocks(turns, conversations)
    nodes = stage(_rolled(rows), "nodes")
    at = nodes.select("depth", F.col("d1").alias("x1"), F.col("d2").alias("x2"), F.col("conv").alias("node"))
    # Each conversation's own path: its first node, its end, the bytes it adds and those above it.
    paths = stage(nodes.groupBy("conv").agg(
        F.min("depth").alias("first"), F.max("depth").alias("end"), F.sum("bytes").alias("own"), F.min("passed").alias("above")), "paths")
    heads = stage(nodes.join(paths.select("conv", F.col("first").alias("depth")), ["conv", "depth"]).filter("depth > 0").select(
        "conv", "depth", (F.col("depth") - 1).alias("up"), F.col("e1").alias("x1"), F.col("e2").alias("x2")).join(
        at.withColumnRenamed("depth", "up"), ["up", "x1", "x2"]).select("conv", "depth", "up", F.col("node").alias("parent")), "heads")
    grafts = stage(heads.groupBy(F.col("parent").alias("conv"), F.col("up").alias("depth")).agg(F.count(F.lit(1)).alias("grafted")), "grafts")
    leaves = paths.select("conv", F.col("end").alias("depth")).join(grafts, ["conv", "depth"], "left_anti").select(
        "conv", F.lit(1).cast("bigint").alias("leaf"))
    none = F.lit(0).cast("bigint")
    facts = stage(ends.select("conv", "total").join(paths.select("conv", "own"), "conv", "left").join(leaves, "conv", "left").select(
        "conv", "total", F.coalesce("own", none).alias("own"), F.coalesce("leaf", none).alias("leaf")), "facts")
    summed = stage(_rolled(rows.join(facts, "conv"), "total", "own", "leaf").select(
        "conv", "depth", "n_convs", "passed", "total", "own", F.col("leaf").alias("n_leaves")), "sums")
    told = stage(_end_digests(ends.join(at, ["depth", "x1", "x2"]).select(
        F.col("node").alias("conv"), "depth", F.col("conv").alias("member"))), "digests")
    found = summed.join(heads.select("conv", "depth", "parent"), ["conv", "depth"], "left").join(
        grafts, ["conv", "depth"], "left").join(told, ["conv", "depth"], "left").join(paths.select("conv", "end", "above"), "conv")
    return found.select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "conv")).alias("parent_conv_id"), "n_convs",
        (F.coalesce("grafted", none) + (F.col("depth") < F.col("end")).cast("bigint")).alias("n_children"), "n_leaves",
        (F.col("total") - (F.col("n_convs") - 1) * F.col("passed") - F.col("own") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
