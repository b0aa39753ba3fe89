"""A corpus made ready for training: each stage is written as Parquet and read again as the next one's input.

What a stage stages on the way lies in a folder of its own and is deleted when the next but one of the same thread begins,
as its result has been written by then.

In every stage NULLs in columns it does not judge pass through, repeated rows are rows of their own unless it says
otherwise, columns may have any names, and an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakewarden.llm import minhash, mixing, packing, quality, secrets
from lakewarden.session import release, scratch, shared_path
from lakewarden.sources.tables import load


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; NULL and empty texts have no words and go too."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates one document stays; repeated rows are one class, a text without words is alone in its own."""
    return minhash.keep_first(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Values that look like live credentials are blanked; all documents stay, a NULL text as it is."""
    return secrets.redact_live(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a NULL source is a source, a text without words is not taken."""
    return mixing.mixed_documents(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A place in a sequence for every piece of every document; a NULL or empty text is its end id alone."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


Step = Callable[[SparkSession, DataFrame, str], DataFrame]


# Scratch folders of the last two stages that this thread began.
_recent: ContextVar[tuple[str, ...]] = ContextVar("recent", default=())


def _tidy(number: int, step: Step) -> Step:
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        *done, last = _recent.get() or (None,)
        for name in done:
            release(spark, name)
        own = f"pipeline-{number}-{uuid.uuid4().hex[:12]}"
        _recent.set((last, own) if last else (own,))
        with scratch(own):
            return step(spark, docs, sf_dir)

    run_step.__doc__ = step.__doc__
    return run_step


_STEPS = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("mixing sources", source_mix),
    ("best-fit packing", best_fit),
]
STAGES = [(name, _tidy(i, step)) for i, (name, step) in enumerate(_STEPS)]

# The votes' model, the signatures and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES:
        path = shared_path(spark, "pipeline-" + name.replace(" ", "-"))
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
