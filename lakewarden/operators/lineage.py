"""Lineage over edge tables: direct neighbours, closure, column flow, erasure map."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lakewarden.session import shared_path, stage, watched


# Origins whose searches share one number.
WORD_BITS = 64
# Bytes of one frontier row, against the planner's broadcast threshold.
ROW_BYTES = 64
# The filter of asked keys: so many bits, 8 MB, whatever the number of keys.
FILTER_BITS = 1 << 26
# More asked keys than this are looked for through the filter first.
FILTER_ABOVE = 100_000
# Pairs of target and source table that one task makes column edges of.
PAIRS_PER_TASK = 1 << 18
# Bits of the filter of one file's keys.
FILE_BITS = 1 << 20


@contextmanager
def hash_laid(edges: DataFrame) -> Iterator[DataFrame]:
    """The distinct edges as a table bucketed by ``src``, under a name of its own until the block ends.

    A join on ``src`` reads it without a shuffle. The files lie in the shared folder.
    """
    spark = edges.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"lakewarden_edges_{uuid.uuid4().hex}"
    arcs = edges.repartition(n, "src").distinct()
    watched(arcs, "laid edges").write.format("parquet").bucketBy(n, "src").sortBy("src").option(
        "path", shared_path(spark, "edges")).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def closure(edges: DataFrame, roots: DataFrame, max_depth: int | None = None, stored: bool = False) -> DataFrame:
    """Every node that can be reached from the roots, with its smallest depth.

    ``edges`` has (src, dst), ``roots`` has (node) or (origin, node) to keep one result per origin.
    ``stored`` says that the edges are a plain stored table, which need not be written first.
    While the frontier is small the planner broadcasts it by its file size, and the edges are not shuffled. Before
    the first frontier beyond that size they are made distinct and hash-laid by ``src``, once, so that this hop and all later
    ones shuffle the frontier alone. Origins are searched 64 at a time: each has a bit, a node holds the bits of the
    origins that reach it, and a hop is one ``bit_or`` per node, in which the bits that were there before cancel
    out. So cycles end, and the rows of a hop do not grow with the number of origins. New nodes are written to the
    shared folder and become the next frontier; a lost executor costs no more than its task. The visited nodes
    are read again in each hop.
    """
    spark = edges.sparkSession
    single = "origin" not in roots.columns
    base = shared_path(spark, "closure")
    if single:
        first = roots.select(F.lit(0).cast("bigint").alias("word"), "node", F.lit(1).cast("bigint").alias("bits")).dropna().distinct()
    else:
        asked = roots.select("origin", "node").dropna().distinct()
        number = F.monotonically_increasing_id()
        origins = stage(asked.select("origin").distinct().select("origin", number.alias("n")).select(
            "origin", F.floor(F.col("n") / WORD_BITS).cast("bigint").alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("n") % WORD_BITS).cast("int")).alias("bit")), "origins")
        first = asked.join(origins, "origin").groupBy("word", "node").agg(F.bit_or("bit").alias("bits"))
    schema = first.schema

    def write(df: DataFrame, depth: int) -> int:
        seen = Observation()
        watched(df, "hop").observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{base}/depth={depth}")
        return seen.get["n"]

    def read(*depths: int) -> DataFrame:
        return spark.read.schema(schema).parquet(*[f"{base}/depth={i}" for i in depths])

    none = F.lit(0).cast("bigint")
    arcs = edges.select("src", "dst").filter("src is not null and dst is not null and src <> dst")
    most = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    with ExitStack() as laid:
        depth, new, large = 0, write(first, 0), False
        # Edges that the first hop lays out are written once, in that form.
        if not stored and new * ROW_BYTES <= most:
            arcs = stage(arcs, "edges")
        while new and (max_depth is None or depth < max_depth):
            depth += 1
            if not large and new * ROW_BYTES > most:
                arcs, large = laid.enter_context(hash_laid(arcs)), True
            met = arcs.join(read(depth - 1), F.col("src") == F.col("node")).select("word", F.col("dst").alias("node"), "bits")
            known = read(*range(depth))
            if single:
                reached = met.groupBy("word", "node").agg(F.bit_or("bits").alias("bits")).join(known, ["word", "node"], "left_anti")
            else:
                both = met.withColumn("seen", none).unionByName(known.select("word", "node", none.alias("bits"), F.col("bits").alias("seen")))
                reached = both.groupBy("word", "node").agg(F.bit_or("bits").alias("bits"), F.bit_or("seen").alias("seen")).select(
                    "word", "node", F.col("bits").bitwiseAND(F.bitwise_not("seen")).alias("bits")).filter("bits <> 0")
            new = write(reached, depth)
    result = spark.read.schema(StructType([*schema.fields, StructField("depth", IntegerType())])).option("basePath", base).parquet(base)
    if single:
        return result.select("node", "depth")
    return result.join(origins, "word").filter(F.col("bits").bitwiseAND(F.col("bit")) != 0).select("origin", "node", "depth")


def trailing(col: str, as_of: date, days: int = 7) -> Column:
    """The days before ``as_of`` and that day itself; what comes later is outside."""
    return F.col(col).between(F.date_sub(F.lit(as_of), days), F.lit(as_of))


def upstream(events: DataFrame, table: str, as_of: date, days: int = 7) -> DataFrame:
    """Direct sources of a table in the trailing window, newest first.

    ``events`` may hold an edge many times; it is filtered first and then reduced to the newest event, so an
    edge that was used in the window and also later is found.
    """
    hit = (F.col("target_table_full_name") == table) & trailing("event_date", as_of, days)
    return events.filter(hit).groupBy("source_table_full_name", "target_table_full_name", "entity_type").agg(
        F.max("event_date").alias("event_date")).orderBy(F.col("event_date").desc(), "source_table_full_name")


def downstream(events: DataFrame, table: str, as_of: date, days: int = 7) -> DataFrame:
    """Direct consumers of a table in the trailing window."""
    hit = (F.col("source_table_full_name") == table) & trailing("event_date", as_of, days)
    return events.filter(hit).select("target_table_full_name").distinct()


def impact(edges: DataFrame, roots: DataFrame, direction: str = "down", max_depth: int | None = None) -> DataFrame:
    """All tables up or down the lineage of the roots, with depth."""
    ends = ["source_table_full_name", "target_table_full_name"]
    src, dst = ends if direction == "down" else reversed(ends)
    return closure(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")), roots, max_depth)


def pii_flow(column_edges: DataFrame, cols: list[str], as_of: date, days: int = 7) -> DataFrame:
    """Where the named source columns end up, in the trailing window; events of one edge count once."""
    hit = F.col("source_column_name").isin(*cols) & trailing("event_date", as_of, days)
    return column_edges.filter(hit).select(
        "source_table_full_name", "source_column_name", "target_table_full_name", "target_column_name",
    ).distinct().orderBy("source_column_name", "target_table_full_name", "source_table_full_name", "target_column_name")


def column_node(side: str) -> Column:
    return F.concat_ws(".", f"{side}_table_full_name", f"{side}_column_name")


def column_arcs(column_edges: DataFrame) -> DataFrame:
    return column_edges.select(column_node("source").alias("src"), column_node("target").alias("dst"))


def pii_flow_closure(column_edges: DataFrame, cols: list[str], source_prefix: str,
                     max_depth: int | None = None) -> DataFrame:
    """Columns reached, over any number of hops and renames, from the named columns of source tables."""
    is_root = F.col("source_column_name").isin(*cols) & F.startswith("source_table_full_name", F.lit(source_prefix))
    marked = column_edges.select(column_node("source").alias("src"), column_node("target").alias("dst"), is_root.alias("is_root"))
    arcs = stage(marked, "edges")
    return closure(arcs, arcs.filter("is_root").select(F.col("src").alias("node")), max_depth, stored=True)


def pii_leaks(reached: DataFrame, forbidden_prefix: str, masked_columns: list[str]) -> DataFrame:
    """Reached columns in the forbidden layer whose name has no mask attached."""
    column = F.substring_index("node", ".", -1)
    return reached.filter(F.startswith("node", F.lit(forbidden_prefix)) & ~column.isin(*masked_columns))


def merge_edges(automatic: DataFrame, external: DataFrame) -> DataFrame:
    """Both kinds of edges; one that is in both stays automatic."""
    tagged = automatic.withColumn("origin", F.lit("automatic")).unionByName(
        external.withColumn("origin", F.lit("external")))
    return tagged.groupBy("source_table_full_name", "target_table_full_name").agg(F.min("origin").alias("origin"))


def edges_from_steps(steps: DataFrame) -> DataFrame:
    """Edges of declared steps (target, sources array, functions array)."""
    tables = F.transform("sources", lambda s: F.struct(s.alias("source"), F.lit("TABLE").alias("entity_type")))
    functions = F.transform("functions", lambda f: F.struct(f.alias("source"), F.lit("FUNCTION").alias("entity_type")))
    return steps.select(F.col("target"), F.inline(F.concat(tables, functions))).select(
        F.col("source").alias("source_table_full_name"), F.col("target").alias("target_table_full_name"), "entity_type",
    ).distinct()


@dataclass
class StepSpec:
    """A declared kind of step: what its sources are called and what each of its columns is made from.

    ``sources`` is {alias: columns of that source}. ``columns`` is {column: SQL expression}; ``"*"`` and ``"alias.*"`` as
    names stand for themselves and take every column over under its own name.
    """

    kind: str
    sources: dict[str, list[str]]
    columns: dict[str, str]


def referenced(spark: SparkSession, expression: str) -> list[list[str]]:
    """The name parts of each column that an expression reads, by the session's own parser; a star ends in ``*``.

    Variables of lambda functions are none. A subquery reads tables that the step does not declare and raises.
    """
    jvm = spark._jvm.org.apache.spark.sql.catalyst
    tree = spark._jsparkSession.sessionState().sqlParser().parseExpression(expression)
    if jvm.expressions.SubqueryExpression.hasSubquery(tree):
        raise ValueError(f"a subquery in {expression!r}")

    def parts(seq) -> list[str]:
        return [seq.apply(i) for i in range(seq.size())]

    found = []
    for leaf in parts(tree.collectLeaves()):
        kind = leaf.getClass().getSimpleName()
        if kind == "UnresolvedAttribute":
            found.append(parts(leaf.nameParts()))
        elif kind == "UnresolvedStar":
            found.append([*(parts(leaf.target().get()) if leaf.target().isDefined() else []), "*"])
    return found


def column_map(spark: SparkSession, spec: StepSpec) -> list[tuple[str, str, str]]:
    """(alias, source column, target column), distinct. Names are matched without regard to case.

    A name belongs to the alias before it, or else to the one source that has such a column; none or several raise,
    and so does an unknown alias. Fields of a struct count as the struct's column.
    """
    known = {a.lower(): (a, {c.lower(): c for c in columns}) for a, columns in spec.sources.items()}

    def resolve(name: list[str]) -> list[tuple[str, str]]:
        first, rest = name[0].lower(), name[1:]
        if name[-1] == "*":
            if rest and first not in known:
                raise ValueError(f"{spec.kind}: no source {name[0]!r}")
            return [(a, c) for k, (a, columns) in known.items() if not rest or k == first for c in columns.values()]
        if rest and first in known and rest[0].lower() in known[first][1]:
            return [(known[first][0], known[first][1][rest[0].lower()])]
        hits = [(a, columns[first]) for a, columns in known.values() if first in columns]
        if len(hits) != 1:
            raise ValueError(f"{spec.kind}: {'.'.join(name)!r} is in {len(hits)} sources")
        return hits

    found = set()
    for target, expression in spec.columns.items():
        star = target == "*" or target.endswith(".*")
        for name in referenced(spark, target if star else expression):
            found |= {(a, c, c if star else target) for a, c in resolve(name)}
    return sorted(found)


def column_edges_from_steps(steps: DataFrame, specs: list[StepSpec]) -> DataFrame:
    """Column edges of the steps that ran: (kind, target, sources array of (alias, table)).

    The specs are declarations and are read on the driver; the steps are data and meet them by kind and alias. A
    step of an undeclared kind has no edges. The result has the columns of recorded column events.

    There are few kinds and aliases, so the declared map is broadcast and the steps are never shuffled by them. They are
    dealt out by target and source table instead, to as many tasks as their number asks for, before they are multiplied
    into edges; equal edges meet in one task, so each task's memory is that of ``PAIRS_PER_TASK`` pairs.
    """
    spark = steps.sparkSession
    rows = [(s.kind, *edge) for s in specs for edge in column_map(spark, s)]
    declared = spark.createDataFrame(rows, "kind string, alias string, source_column_name string, target_column_name string")
    pairs = steps.agg(F.sum(F.greatest(F.size("sources"), F.lit(0)))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-pairs // PAIRS_PER_TASK))
    ran = steps.select("kind", "target", F.inline("sources")).repartition(tasks, "target", "table")
    return ran.join(F.broadcast(declared), ["kind", "alias"]).select(
        F.col("table").alias("source_table_full_name"), "source_column_name",
        F.col("target").alias("target_table_full_name"), "target_column_name").distinct()


def _places(key: Column, bits: int) -> tuple[Column, Column]:
    """Bitmap number and bit of a key's hash among so many bits."""
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    return F.bitmap_bucket_number(place), F.bitmap_bit_position(place)


def key_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """(bucket, bitmap): a Bloom filter of the keys with one hash, at most ``bits`` / 8 bytes in all."""
    bucket, bit = _places(F.col(key), bits)
    return keys.filter(F.col(key).isNotNull()).select(bucket.alias("bucket"), bit.alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("bitmap"))


def might_hold(df: DataFrame, key: str, found: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose key may be in the filter; all that are, and few others. Its bounded size is broadcast."""
    return held_in(df, *_places(F.col(key), bits), found)


def held_in(df: DataFrame, bucket: Column, bit: Column, found: DataFrame) -> DataFrame:
    """The rows whose bit is set in the bitmap of their bucket; ``found`` is (bucket, bitmap), of bounded size, and broadcast."""
    probed = df.withColumn("_bucket", bucket).withColumn("_bit", bit).join(
        F.broadcast(found.select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap"))), "_bucket")
    byte = F.conv(F.hex(F.expr("substring(_bitmap, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (F.col("_bit") % 8).cast("int"))) != 0
    return probed.filter(hit).drop("_bucket", "_bit", "_bitmap")


def file_index(df: DataFrame, key: str, bits: int = FILE_BITS) -> DataFrame:
    """(file, bucket, low, high, bitmap): the range and a filter of each file's keys. Made once for stored files."""
    bucket, bit = _places(F.col(key), bits)
    rows = df.filter(F.col(key).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col(key).alias("key"), bucket.alias("bucket"), bit.alias("bit"))
    return rows.groupBy("file", "bucket").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.bitmap_construct_agg("bit").alias("bitmap"))


def files_holding(index: DataFrame, keys: DataFrame, key: str, bits: int = FILE_BITS) -> list[str]:
    """Files that may hold one of the keys: the filters have a bit in common, within the range of the file's keys.

    Only names come to the driver, which lists the files of any scan.
    """
    bucket, bit = _places(F.col(key), bits)
    asked = keys.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), bucket.alias("bucket"), bit.alias("bit")).groupBy("bucket").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.bitmap_construct_agg("bit").alias("asked"))
    met = index.join(asked, "bucket").filter("first <= high and last >= low")
    both = met.select("file", "bucket", F.explode(F.array("bitmap", "asked")).alias("bitmap")).groupBy("file", "bucket").agg(
        F.bitmap_and_agg("bitmap").alias("both"))
    return sorted(r["file"] for r in both.filter(F.bitmap_count("both") > 0).select("file").distinct().collect())


def subject_map(tables: dict[str, tuple[DataFrame, str]], ids: DataFrame, filter_above: int = FILTER_ABOVE) -> DataFrame:
    """Rows per table that hold one of the asked keys: the map for an erasure request.

    ``tables`` is {name: (table, key column)}. Rows of other keys are dropped before they are counted: by a
    join with the asked ids, which the planner broadcasts while they are few; more than ``filter_above`` of them are
    looked for through a filter of bounded size first, so that few others reach the shuffle.
    """
    wanted = stage(ids.select("subject_id").dropna().distinct(), "asked")
    kind = wanted.schema["subject_id"].dataType
    probe = stage(key_filter(wanted, "subject_id"), "filter") if wanted.count() > filter_above else None
    out = None
    for name, (df, key) in tables.items():
        rows = df.select(F.col(key).cast(kind).alias("subject_id"))
        if probe is not None:
            rows = might_hold(rows, "subject_id", probe)
        found = rows.join(wanted, "subject_id", "left_semi").groupBy("subject_id").agg(F.count(F.lit(1)).alias("n_rows")).select(
            "subject_id", F.lit(name).alias("table_name"), "n_rows")
        out = found if out is None else out.unionByName(found)
    return out
