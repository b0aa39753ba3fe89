"""Sources mixed to target weights along a low-discrepancy schedule.

Every source's documents, in the order of a hash, form one stream of words that is cut into blocks of equal
size. The schedule is a row of slots. Slot i has the golden-ratio point frac(i * 0.618...), kept as an exact
integer; the point falls into one source's part of the cumulative weights, so every stretch of the schedule
holds the sources near their shares. The slots of a source are ranked, and its n-th slot takes its n-th block,
starting over at the end of the stream. A source whose points run out early gets its last slots after the row's
end, so each one takes its target to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import SPACE, WORD, named, word_count
from lakewarden.session import stage

# Weights by the place of a source, and how often a document may be repeated.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 256
# Documents or slots ranked together in one task.
SLICE_ROWS = 2_000
# The golden ratio's fraction on a ring of 2^31 points; odd, so the points of a round are all different.
RING = 1 << 31
STEP = 1_327_217_885

_BEFORE = (Window.unboundedPreceding, -1)


def source_key(source: Column) -> Column:
    """A string that is never NULL and sorts as sources do: by code point (UTF-8 bytes keep that order), NULL last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _running(value: str, over) -> Column:
    return F.coalesce(F.sum(value).over(over.rowsBetween(*_BEFORE)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(key, source_size, weight, target, words) per source, ``key`` as made by ``source_key``.

    Every source first gets its share by weight of all words; what exceeds ``most`` times its size is shared
    again by weight among the rest, until none is above. Each round reads two sums. There is one row per
    source here, not per document; giving weights by place needs them in one order.
    """
    sizes = sized.groupBy("key").agg(F.sum("size").cast("bigint").alias("source_size"))
    place = F.row_number().over(Window.orderBy("key")) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    table = stage(sizes.withColumn("weight", F.get(cycle, F.pmod(place, F.lit(len(weights)))).cast("bigint")), "sources")
    whole = int(table.agg(F.sum("source_size")).first()[0] or 0)
    cap = F.col("source_size") * most
    rate = 0.0
    while True:
        # Once capped, a source stays so: the rate only rises.
        full = cap <= F.lit(rate) * F.col("weight")
        got = table.agg(F.sum(F.when(full, cap)).alias("fixed"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        new = (whole - int(got["fixed"] or 0)) / int(got["open"]) if got["open"] else rate
        if new <= rate:
            break
        rate = new
    target = F.least(cap.cast("double"), F.lit(rate) * F.col("weight"))
    return table.withColumn("target", target).withColumn("words", F.least(cap, F.round("target").cast("bigint")))


def streams(sized: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``sized`` with ``start``: the words of its source's stream before each document.

    The order is that of the hash in ``order``; its first hex digits cut a source into slices whose words are
    summed first, so no task holds a whole source.
    """
    rows = sized.count()
    digits = 0
    while 16 ** digits * slice_rows < rows and digits < 8:
        digits += 1
    cut = sized.withColumn("_slice", F.substring("order", 1, digits))
    before = cut.groupBy("key", "_slice").agg(F.sum("size").alias("_words")).withColumn(
        "_before", _running("_words", Window.partitionBy("key").orderBy("_slice"))).drop("_words")
    within = Window.partitionBy("key", "_slice").orderBy("order", "size", "tie")
    local = cut.withColumn("_local", _running("size", within))
    return local.join(before, ["key", "_slice"]).withColumn("start", F.col("_before") + F.col("_local")).drop(
        "_slice", "_before", "_local")


def slot_needs(targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """Per source that takes words: blocks of its stream, slots it needs, and where its points lie on the ring."""
    size, words = F.col("source_size"), F.col("words")
    left = words - F.floor(words / size).cast("bigint") * size
    needs = targets.filter("words > 0").select(
        "key", "source_size", "words", F.ceil(size / F.lit(block)).cast("bigint").alias("n_blocks"),
        (F.floor(words / size).cast("bigint") * F.ceil(size / F.lit(block)).cast("bigint")
         + F.ceil(left / F.lit(block)).cast("bigint")).alias("n_slots"))
    needs = stage(needs, "needs")
    total = int(needs.agg(F.sum("n_slots")).first()[0] or 0)
    upto = F.sum("n_slots").over(Window.orderBy("key"))
    edge = lambda c: F.floor(c.cast("decimal(38,0)") * F.lit(RING) / F.lit(max(total, 1))).cast("bigint")
    return needs.withColumn("_upto", upto).select(
        "*", edge(F.col("_upto") - F.col("n_slots")).alias("low"), edge(F.col("_upto")).alias("high"),
        F.lit(total).alias("total"))


def schedule(targets: DataFrame, block: int = BLOCK_WORDS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(slot, key, rank, block, words): which block each slot of the mix takes, and how many of its words.

    Points are matched to sources by the cells of an even grid on the ring, so the join is on equal cells.
    """
    needs = stage(slot_needs(targets, block), "slots")
    spark = needs.sparkSession
    head = needs.agg(F.max("total").alias("total"), F.count(F.lit(1)).alias("n")).first()
    total, grid = int(head["total"] or 0), 1
    while grid < 4 * int(head["n"]) and grid < 1 << 20:
        grid *= 2
    width = RING // grid
    point = F.pmod(F.pmod(F.col("slot"), F.lit(RING)) * F.lit(STEP), F.lit(RING))
    slots = spark.range(total).select(F.col("id").alias("slot")).withColumn("_point", point).withColumn(
        "_cell", F.floor(F.col("_point") / F.lit(width)).cast("bigint"))
    parts = needs.filter("high > low").withColumn("_cell", F.explode(F.sequence(
        F.floor(F.col("low") / F.lit(width)).cast("bigint"), F.floor((F.col("high") - 1) / F.lit(width)).cast("bigint"))))
    met = slots.join(parts.select("_cell", "key", "low", "high"), "_cell").filter("_point >= low and _point < high").select(
        "slot", "key", F.floor(F.col("slot") / F.lit(slice_rows)).cast("bigint").alias("_chunk"))
    counts = met.groupBy("key", "_chunk").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", _running("_n", Window.partitionBy("key").orderBy("_chunk"))).drop("_n")
    ranked = met.withColumn("_local", F.row_number().over(Window.partitionBy("key", "_chunk").orderBy("slot")) - 1).join(
        counts, ["key", "_chunk"]).select("slot", "key", (F.col("_before") + F.col("_local")).alias("rank"))
    filled = stage(ranked, "schedule")
    have = filled.groupBy("key").agg(F.count(F.lit(1)).alias("_have"))
    facts = ["source_size", "words", "n_blocks", "n_slots"]
    # Sources whose points are too few, or too narrow for the ring, take the missing slots after the last one.
    late = needs.join(have, "key", "left").withColumn("_have", F.coalesce("_have", F.lit(0))).filter("_have < n_slots").select(
        "key", F.lit(total).cast("bigint").alias("slot"),
        F.explode(F.sequence(F.col("_have"), F.col("n_slots") - 1)).alias("rank"), *facts)
    early = filled.join(needs.select("key", *facts), "key").filter("rank < n_slots").select("key", "slot", "rank", *facts)
    both = early.unionByName(late).withColumn("block", F.pmod("rank", "n_blocks"))
    whole_block = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    passed = F.floor(F.col("rank") / F.col("n_blocks")).cast("bigint") * F.col("source_size") + F.col("block") * block
    return both.select("slot", "key", "rank", "block", F.least(whole_block, F.col("words") - passed).alias("words"))


def mix(df: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
        carry: list[str] | None = None, block: int = BLOCK_WORDS) -> DataFrame:
    """``_row`` (the columns of ``df``, or those to ``carry``) with ``size``, ``source_size``, ``target``, ``taken``.

    ``taken`` adds up, over all slots, the words of the document that lie in the slot's block. A document
    without words (NULL or empty text) is never taken; NULL is a source of its own, the last one; a NULL id is
    ordered like an empty one; repeated rows lie in the stream one after the other and each has its own share;
    an empty table gives no rows; names cannot clash, as the columns of ``df`` stay inside ``_row``.
    Reruns agree: the order comes from hashes of the id and the text.
    """
    # Written with the row's number, so that each row keeps its own however often the table is read.
    sized = stage(df.select(
        F.monotonically_increasing_id().alias("rid"),
        F.struct(*[named(df, c) for c in (df.columns if carry is None else carry)]).alias("_row"),
        source_key(named(df, source_col)).alias("key"),
        F.md5(F.coalesce(named(df, id_col).cast("string"), F.lit("")).cast("binary")).alias("order"),
        F.xxhash64(named(df, text_col)).alias("tie"), word_count(named(df, text_col)).alias("size")), "sized")
    light = sized.drop("_row")
    targets = source_targets(light)
    used = schedule(targets, block).groupBy("key", "block", "words").agg(F.count(F.lit(1)).alias("_times"))
    placed = streams(light)
    first, last = F.floor(F.col("start") / F.lit(block)), F.floor((F.col("start") + F.col("size") - 1) / F.lit(block))
    spread = placed.filter("size > 0").select("rid", "key", "start", "size", F.explode(
        F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("block"))
    lies = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words")) - F.greatest(
        F.col("start"), F.col("block") * block)
    taken = spread.join(used, ["key", "block"]).groupBy("rid").agg(
        F.sum(F.greatest(lies, F.lit(0)) * F.col("_times")).cast("bigint").alias("taken"))
    rows = sized.select("rid", "_row", "key", "size").join(targets.select("key", "source_size", "target"), "key")
    return rows.join(taken, "rid", "left").select(
        "_row", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixed_documents(df: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
                    length_col: str | None = "n_chars") -> DataFrame:
    """The mix itself, with the columns of ``df``: each document as often as it is taken whole, then once more
    cut after the last word taken, where that is not the whole.

    NULL, empty and wordless texts are never taken. A NULL source is a source like others, repeated rows are taken
    each for itself, other columns pass through whatever their names, an empty table gives no rows.
    """
    mixed = mix(df, source_col, text_col, id_col).filter("taken > 0")
    left = F.pmod("taken", "size")
    copies = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.ceil(F.col("taken") / F.col("size")))))
    part = F.when((left > 0) & (F.col("_copy") * F.col("size") > F.col("taken")), left)
    words = F.regexp_extract_all(F.col("_row").getField(text_col), F.lit(f"{SPACE}*{WORD}"), F.lit(0))
    cut = F.when(part.isNotNull(), F.array_join(F.slice(words, F.lit(1), part.cast("int")), "")).otherwise(F.col("_row").getField(text_col))
    made = copies.withColumn("_new", cut)
    columns = []
    for c in df.columns:
        own = F.col("_row").getField(c)
        if c == text_col:
            own = F.col("_new")
        elif c == length_col:
            own = F.when(part.isNotNull(), F.length("_new").cast(df.schema[c].dataType)).otherwise(own)
        columns.append(own.alias(c))
    return made.select(*columns)


def mixed_blocks(df: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
                 block: int = BLOCK_WORDS) -> DataFrame:
    """The mix in the schedule's order: (slot, key, rank, block, words, text), range-partitioned and sorted by slot.

    ``key`` is the source as made by ``source_key``; ``text`` is the slot's words, with a line break where a document
    begins. Slots that a source lacks share the slot after the last one, in the order of ``key`` and ``rank``.
    """
    sized = stage(df.select(
        F.monotonically_increasing_id().alias("rid"), named(df, text_col).alias("_text"),
        source_key(named(df, source_col)).alias("key"),
        F.md5(F.coalesce(named(df, id_col).cast("string"), F.lit("")).cast("binary")).alias("order"),
        F.xxhash64(named(df, text_col)).alias("tie"), word_count(named(df, text_col)).alias("size")), "sized")
    light = sized.drop("_text")
    slots = schedule(source_targets(light), block)
    placed = streams(light).filter("size > 0").select("rid", "key", "start", "size").join(sized.select("rid", "_text"), "rid")
    first, last = F.floor(F.col("start") / F.lit(block)), F.floor((F.col("start") + F.col("size") - 1) / F.lit(block))

    def piece(words: Column, at: Column) -> Column:
        begin = F.greatest(at * block - F.col("start"), F.lit(0))
        end = F.least((at + 1) * block - F.col("start"), F.col("size"))
        own = F.slice(words, (begin + 1).cast("int"), (end - begin).cast("int"))
        return F.struct(at.alias("block"), F.when(begin == 0, F.transform(own, lambda w, i: F.when(
            i == 0, F.concat(F.lit("\n"), w)).otherwise(w))).otherwise(own).alias("own"))

    # The words are bound once per text, however many blocks it reaches into.
    found = F.array(F.regexp_extract_all("_text", F.lit(f"{SPACE}*{WORD}"), F.lit(0)))
    cut = F.flatten(F.transform(found, lambda words: F.transform(
        F.sequence(first.cast("bigint"), last.cast("bigint")), lambda at: piece(words, at))))
    # A block has a bounded number of words, and so of pieces.
    texts = placed.select("key", "start", F.explode(cut).alias("p")).groupBy("key", F.col("p.block").alias("block")).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "p.own"))), lambda x: x["own"])).alias("_words"))
    return slots.join(texts, ["key", "block"]).select(
        "slot", "key", "rank", "block", "words", F.array_join(F.slice("_words", F.lit(1), F.col("words").cast("int")), "").alias(
            "text")).repartitionByRange("slot", "key", "rank").sortWithinPartitions("slot", "key", "rank")


def write_mix(blocks: DataFrame, path: str) -> None:
    """What ``mixed_blocks`` returns as files, each holding one stretch of the schedule."""
    blocks.write.parquet(path)
