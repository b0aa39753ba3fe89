"""Secrets in free text, judged by how widely their values are owned.

Candidates are found by patterns, with their places: the text between matches comes from ``split``, the matches
from ``regexp_extract_all``, and a window over the matches adds their lengths up to positions. Over the corpus the hash of each value is counted
by distinct repositories and owners. A value that many owners hold in many repositories, or one owner in very many,
is a copied example; one that few hold looks like somebody's live credential. Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import named
from lakewarden.session import stage

# The base kinds as listed, with pattern, group that holds the value, and its least length.
# A run of 16 or 14 more characters is the same as any run kept only at that length, since runs are maximal.
BASE = (
    ("assign", "((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
               "|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?)([A-Za-z0-9+/_.=-]+)", 2, 12),
    ("access", "AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),
)
# Kinds that are added to the listed ones.
OWNED = (
    ("vendor", "(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abpr]-[A-Za-z0-9-]{20,}|sk-[A-Za-z0-9_-]{24,}|AIza[A-Za-z0-9_-]{35})", 0, 20),
    ("signed", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", 0, 28),
)
KINDS = tuple(k for k, *_ in BASE + OWNED)
# A value that at least so many owners hold, in at least so many repositories, is an example. In fewer repositories it
# is not, whoever owns them: taking a rare example for live blanks few texts, the opposite shows a credential.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 6
# So is one with this many repositories for each of its owners, however few these are.
COPIES_PER_OWNER = 100

# Characters of one block of a text that is cut in many places.
BLOCK_CHARS = 4096


def _matches(text: Column, place: int, pattern: str, group: int, least: int) -> Column:
    """Matches of one kind in order, each with the length of the text since the one before; too short ones without a hash."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))  # one more than the matches
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pieces = F.arrays_zip(gaps.alias("gap"), F.transform(found, lambda m: F.length(m)).alias("len"), values.alias("value"))
    matches = F.transform(F.filter(pieces, lambda m: m["len"].isNotNull()), lambda m, i: F.struct(
        F.lit(place).alias("place"), i.alias("n"), m["gap"].alias("gap"), m["len"].alias("len"),
        F.when(F.length(m["value"]) >= least, F.sha2(m["value"], 256)).alias("hash")))
    none = F.array().cast("array<struct<place:int,n:int,gap:int,len:int,hash:string>>")
    return F.when(text.rlike(pattern), matches).otherwise(none)


def candidates(df: DataFrame, text_col: str, id_col: str, owner_col: str, carry: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): (rid, _row), and (rid, start, place, end, kind, hash, repository, owner) for each match.

    Texts are searched once. The place of a match is the sum of the lengths before it, taken over rows of matches, so
    the work grows with their number and not with its square.
    """
    text = F.coalesce(named(df, text_col), F.lit(""))
    kept = df.columns if carry is None else carry
    rows = df.select(F.struct(*[named(df, c) for c in kept]).alias("_row"), text.alias("_text"),
                     named(df, id_col).cast("string").alias("repository"), named(df, owner_col).cast("string").alias("owner"))
    found = F.concat(*[_matches(F.col("_text"), n, *rule[1:]) for n, rule in enumerate(BASE + OWNED)])
    texts = stage(rows.select(F.monotonically_increasing_id().alias("rid"), "_row", "repository", "owner", found.alias("found")), "candidates")
    before = Window.partitionBy("rid", "place").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    each = texts.filter(F.size("found") > 0).select("rid", "repository", "owner", F.inline("found"))
    start = F.coalesce(F.sum(F.col("gap") + F.col("len")).over(before), F.lit(0)) + F.col("gap")
    spans = each.withColumn("start", start.cast("int")).filter("hash is not null").select(
        "rid", "start", "place", (F.col("start") + F.col("len")).alias("end"),
        F.element_at(F.array(*map(F.lit, KINDS)), F.col("place") + 1).alias("kind"), "hash", "repository", "owner")
    return texts.select("rid", "_row"), stage(spans, "spans")


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, repositories, owners): how many distinct ones hold each value; NULL counts as one of its own.

    A repository is one of its owner's, so an id that two owners use counts for both.
    """
    held = spans.select("hash", "repository", "owner").distinct()
    # Each (value, owner) first, so a value copied everywhere is counted from few rows.
    by_owner = held.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("_r"))
    return by_owner.groupBy("hash").agg(F.sum("_r").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def _owned(spans: DataFrame, example_owners: int, example_repositories: int, copies_per_owner: int) -> DataFrame:
    """The spans with their values' owners and repositories, and whether they look live."""
    copied = ((F.col("owners") >= example_owners) & (F.col("repositories") >= example_repositories)) | (
        F.col("repositories") >= copies_per_owner * F.col("owners"))
    return spans.drop("repository", "owner").join(ownership(spans), "hash").withColumn("live", ~copied)


def judged(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", owner_col: str = "source",
           carry: list[str] | None = None, example_owners: int = EXAMPLE_OWNERS,
           example_repositories: int = EXAMPLE_REPOSITORIES, copies_per_owner: int = COPIES_PER_OWNER) -> DataFrame:
    """``_row`` (the columns of ``df``, or those to ``carry``) and ``spans``: start, kind, end, owners, repositories, live.

    Spans of all kinds are there, live or not. Sorted by start, then kind as listed. A NULL text counts as empty; a NULL repository or owner counts as one; repeated rows have the
    same spans and count once; an empty table gives no rows; names cannot clash, as the columns stay in
    ``_row``. Values appear as hashes only.
    """
    texts, spans = candidates(df, text_col, id_col, owner_col, carry)
    told = _owned(spans, example_owners, example_repositories, copies_per_owner).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(
        "start", "place", "end", "kind", "owners", "repositories", "live"))).alias("judged"))
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string,owners:bigint,repositories:bigint,live:boolean>>")
    return texts.join(told, "rid", "left").select("_row", F.coalesce("judged", none).alias("spans"))


def _between(blocks: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` of a text in blocks; only the two blocks at the ends are cut."""
    i, j = (F.floor(p / BLOCK_CHARS).cast("int") for p in (start, end))

    def block(k: Column) -> Column:
        return F.coalesce(F.get(blocks, k), F.lit(""))

    inside = F.substring(block(i), start % BLOCK_CHARS + 1, end - start)
    over = F.concat(F.substring(block(i), start % BLOCK_CHARS + 1, F.lit(BLOCK_CHARS)),
                    F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""),
                    F.substring(block(j), F.lit(1), end % BLOCK_CHARS))
    return F.when(i == j, inside).otherwise(over)


def redact_live(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", owner_col: str = "source",
                length_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``df``; spans that look live are replaced by ``mark``, examples stay.

    Overlapping spans are blanked as one. ``length_col``, if there, gets the new length of a changed text.
    """
    texts, spans = candidates(df, text_col, id_col, owner_col)
    live = _owned(spans, EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES, COPIES_PER_OWNER).filter("live")
    before = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    past = F.coalesce(F.max("end").over(before), F.lit(0))
    # What lies between one run of overlapping spans and the next; collected without the spans inside a run.
    cuts = live.select("rid", "start", "end", past.alias("past")).groupBy("rid").agg(
        F.array_sort(F.collect_list(F.when(F.col("start") >= F.col("past"), F.struct(F.col("past").alias("low"), F.col("start").alias("high"))))).alias("_cuts"),
        F.max("end").alias("_last"))
    cuts = stage(cuts, "cuts")
    ids = stage(cuts.select("rid"), "changed")
    # Only changed texts travel; the others are told apart by ids alone, which are broadcast while they are few.
    rest = texts.join(ids, "rid", "left_anti").withColumns({c: F.lit(None).cast(cuts.schema[c].dataType) for c in ("_cuts", "_last")})
    text = F.col("_row").getField(text_col)
    rows = texts.join(ids, "rid", "left_semi").join(cuts, "rid").unionByName(rest).withColumn(
        "_blocks", F.when(F.col("_cuts").isNotNull(), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))))
    kept = F.transform("_cuts", lambda c: F.concat(_between(F.col("_blocks"), c["low"], c["high"]), F.lit(mark)))
    rows = rows.withColumn("_new", F.when(F.col("_cuts").isNotNull(), F.concat(
        F.array_join(kept, ""), _between(F.col("_blocks"), F.col("_last"), F.length(text)))))
    columns = []
    for c in df.columns:
        own = F.col("_row").getField(c)
        if c == text_col:
            own = F.coalesce("_new", own)
        elif c == length_col:
            own = F.coalesce(F.length("_new").cast(df.schema[c].dataType), own)
        columns.append(own.alias(c))
    return rows.select(*columns)
