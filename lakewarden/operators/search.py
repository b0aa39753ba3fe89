"""Ranked search over assets: an inverted index of their names, comments and tags, scored by BM25."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.session import stage

TERM = "[a-z0-9]+"
K1, B = 1.2, 0.75
# Tasks that the postings of one term are dealt to, so a very common term is split.
SPLITS = 16


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


@dataclass
class SearchIndex:
    """``postings`` is (key columns, term, tf, length), sorted by term within its files; ``length`` is the asset's number of terms."""

    key: list[str]
    postings: DataFrame
    n_assets: int
    n_terms: int


def build_index(assets: DataFrame, tags: DataFrame, key: list[str], texts: list[str], tag_texts: list[str],
                splits: int = SPLITS) -> SearchIndex:
    """The index of ``texts`` of the assets and ``tag_texts`` of their tags; both tables carry ``key``.

    Terms are counted per asset, whatever the number of its tags. Tags of unknown assets are left out.
    """
    def exploded(df: DataFrame, columns: list[str]) -> DataFrame:
        return df.select(*key, F.explode(terms_of(F.concat_ws(" ", *columns))).alias("term"))

    known = tags.join(assets.select(*key), key, "left_semi")
    counts = stage(exploded(assets, texts).unionByName(exploded(known, tag_texts)).groupBy(*key, "term").agg(
        F.count(F.lit(1)).alias("tf")), "terms")
    lengths = counts.groupBy(*key).agg(F.sum("tf").alias("length"))
    laid = counts.join(lengths, key).repartition("term", F.pmod(F.xxhash64(*key), F.lit(splits))).sortWithinPartitions("term")
    postings = stage(laid.select(*key, "term", "tf", "length"), "postings")
    return SearchIndex(key, postings, assets.count(), int(counts.agg(F.sum("tf")).first()[0] or 0))


def ranked(index: SearchIndex, query: str, k: int) -> DataFrame:
    """The ``k`` best assets (key columns, score) for the words of ``query``; equal scores come in the order of the key.

    Only postings of the asked words are read; the files are sorted by word. Scores are rounded to six places.
    """
    asked = sorted(set(re.findall(TERM, query.lower())))
    hits = index.postings.filter(F.col("term").isin(asked))
    held = F.count(F.lit(1)).cast("double")
    weights = hits.groupBy("term").agg(F.log(1 + (F.lit(float(index.n_assets)) - held + 0.5) / (held + 0.5)).alias("idf"))
    mean = index.n_terms / index.n_assets if index.n_terms else 1.0
    tf = F.col("tf").cast("double")
    part = F.col("idf") * (tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.lit(mean))))
    return hits.join(weights, "term").groupBy(*index.key).agg(F.round(F.sum(part), 6).alias("score")).orderBy(
        F.col("score").desc(), *index.key).limit(k)
