"""Language of a text by unigrams over pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary. Each language has a probability for every piece, and the
probability of a word is the sum over all ways to cut it into pieces, which a forward pass over its letters adds up.
Learning counts the words of each language over all texts, and repeats: a forward and a backward pass over each
distinct word give the expected number of times that each piece is used, which are the next probabilities. Counts
are kept in whole numbers, so the order of rows cannot change what is learnt.

Many words go through a pass at once: those of one length are the rows of a matrix.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.llm.common import named
from lakewarden.session import stage

# A letter and what follows it of letters and marks; longer runs are cut there.
LONGEST_WORD = 64
WORDS = regex.compile(rf"\p{{L}}[\p{{L}}\p{{M}}]{{0,{LONGEST_WORD - 1}}}")
BEGIN = "▁"
NONE = "und"
# Passes over the distinct words.
ROUNDS = 3
# Pieces that a language gets from all languages' counts, as a number of uses.
SMOOTHING = 200.0
# Chance of a letter that no piece holds; the same in every language, so it tells them not apart.
UNKNOWN = 1e-6
# Each letter's chance is multiplied by this, which keeps sums of long words in range.
LIFT = 32.0
# Expected counts are kept in this fraction of one.
UNIT = float(1 << 16)
# Languages whose probabilities are sent to tasks at once; more are learnt and scored in turns.
LANGUAGES_AT_ONCE = 64
# Words held by a worker, and those that go through a pass at once.
KNOWN_WORDS, PASS_WORDS = 400_000, 20_000
# Characters of text whose words are looked up together.
TEXT_CHARS = 4_000_000

_U = np.uint64
_FACTOR = _U(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


class Pieces:
    """A fixed vocabulary as sorted hashes; a piece's number is its place."""

    def __init__(self, pieces: Iterable[str]):
        own = sorted({p for p in pieces if p and regex.fullmatch(rf"{BEGIN}?[\p{{L}}\p{{M}}]*", p)})
        self.longest = max(map(len, own), default=1)
        hashes = np.array([self._hash(p) for p in own], _U)
        order = np.argsort(hashes)
        self.texts, self.hashes = [own[i] for i in order], hashes[order]

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(_FACTOR) + ord(c) + 1) % (1 << 64)
        return h

    def __len__(self) -> int:
        return len(self.texts)

    def places(self, codes: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """(start, end) to the piece number of that stretch in each word, ``len(self)`` where it is none.

        Only stretches that are a piece of some word are in it, and all single letters.
        """
        n, found = codes.shape[1], {}
        for i in range(n):
            h = np.zeros(len(codes), _U)
            for j in range(i, min(n, i + self.longest)):
                h = h * _FACTOR + codes[:, j] + _U(1)
                at = np.minimum(np.searchsorted(self.hashes, h), max(len(self) - 1, 0))
                hit = self.hashes[at] == h if len(self) else np.zeros(len(h), bool)
                if hit.any() or j == i:
                    found[i, j + 1] = np.where(hit, at, len(self))
        return found


def public_pieces(vocabulary: str) -> Pieces:
    """The pieces of a sentencepiece model's vocabulary."""
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    return Pieces(model.id_to_piece(i) for i in range(model.get_piece_size()))


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, each after the mark of a word's begin."""
    joined = "".join(BEGIN + w for w in words)
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(_U)


def _chances(table: np.ndarray, start: int, end: int, at: np.ndarray) -> np.ndarray:
    """Chance of one stretch per word and language; a single letter that is no piece is unknown, longer ones are none."""
    unknown = UNKNOWN if end == start + 1 else 0.0
    return np.where((at < len(table))[:, None], table[np.minimum(at, len(table) - 1)], unknown) * LIFT ** (end - start)


def _forward(places: dict, table: np.ndarray, n: int, m: int) -> list[np.ndarray]:
    sums = [np.ones((m, table.shape[1]))] + [np.zeros((m, table.shape[1])) for _ in range(n)]
    for (i, j), at in places.items():  # by start, so what is added from is complete
        sums[j] += sums[i] * _chances(table, i, j, at)
    return sums


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        for lo in range(0, len(at), PASS_WORDS):
            yield at[lo:lo + PASS_WORDS]


def word_scores(words: list[str], pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, up to the same amount per letter."""
    out = np.zeros((len(words), table.shape[1]))
    for at in _by_length(words):
        codes = _codes([words[i] for i in at])
        total = _forward(pieces.places(codes), table, codes.shape[1], len(at))[-1]
        out[at] = np.log(np.maximum(total, 1e-300))
    return out


def expected_uses(words: list[str], counts: np.ndarray, pieces: Pieces, chances: np.ndarray) -> np.ndarray:
    """How often each piece is used in words seen ``counts`` times, in units of 1 / ``UNIT``, rounded word by word."""
    out = np.zeros(len(pieces) + 1)
    table = chances[:, None]
    for at in _by_length(words):
        codes = _codes([words[i] for i in at])
        n, m = codes.shape[1], len(at)
        places = pieces.places(codes)
        ahead = _forward(places, table, n, m)
        behind = [np.zeros((m, 1)) for _ in range(n)] + [np.ones((m, 1))]
        for (i, j), p in reversed(places.items()):
            behind[i] += behind[j] * _chances(table, i, j, p)
        share = (counts[at] * UNIT)[:, None] / np.maximum(ahead[n], 1e-300)
        for (i, j), p in places.items():
            used = np.rint(ahead[i] * _chances(table, i, j, p) * behind[j] * share)[:, 0]
            out += np.bincount(p, weights=used, minlength=len(out))
    return out[:-1].astype(np.int64)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n), added up before they leave the task."""
    held: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counter in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counter), pa.string()), pa.array(list(counter), pa.string()), pa.array(counter.values(), pa.int64())],
                names=["lang", "word", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, held.values())) > KNOWN_WORDS:
            yield from flush()
    yield from flush()


def _uses(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, chances = shared.value["pieces"], shared.value["chances"]
        totals: dict[str, np.ndarray] = {}
        waiting: dict[str, tuple[list, list]] = {}

        def add(lang: str) -> None:
            words, counts = waiting.pop(lang)
            totals[lang] = totals.get(lang, 0) + expected_uses(words, np.array(counts, np.float64), pieces, chances[lang])

        for batch in batches:
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                words, counts = waiting.setdefault(lang, ([], []))
                words.append(word)
                counts.append(n)
            for lang in [g for g, (words, _) in waiting.items() if len(words) >= PASS_WORDS]:
                add(lang)
        for lang in list(waiting):
            add(lang)
        for lang, uses in totals.items():
            at = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(uses[at])],
                                             names=["lang", "piece", "uses"])

    return run


@dataclass
class Model:
    """Languages in order, their shares of the texts, and the chance of each piece in each."""

    pieces: Pieces
    languages: list[str]
    shares: np.ndarray
    table: np.ndarray


def learn(df: DataFrame, vocabulary: str, text_col: str = "text", lang_col: str = "lang", rounds: int = ROUNDS) -> list[Model]:
    """A model for each ``LANGUAGES_AT_ONCE`` languages, from all texts whose language is not NULL.

    The words of each language are counted over all texts and staged; only sums per piece, at most vocabulary
    times languages at once, reach the driver. NULL and empty texts count to their language's share alone.
    """
    spark = df.sparkSession
    pieces = public_pieces(vocabulary)
    rows = df.select(named(df, lang_col).cast("string").alias("lang"), named(df, text_col).alias("text")).filter("lang is not null")
    texts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    languages = sorted(texts)
    counts = stage(rows.mapInArrow(_counter, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")), "words")
    return [_learn(spark, counts, pieces, languages[i:i + LANGUAGES_AT_ONCE], texts, rounds)
            for i in range(0, len(languages), LANGUAGES_AT_ONCE)]


def _learn(spark: SparkSession, counts: DataFrame, pieces: Pieces, languages: list[str], texts: dict[str, int], rounds: int) -> Model:
    own = counts.filter(F.col("lang").isin(languages))
    table = np.full((len(pieces), len(languages)), 1.0 / max(len(pieces), 1))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast({"pieces": pieces, "chances": {g: table[:, i] for i, g in enumerate(languages)}})
        used = own.mapInArrow(_uses(shared), "lang string, piece int, uses long").groupBy("lang", "piece").agg(
            F.sum("uses").alias("uses")).toPandas()
        shared.destroy()
        sums = np.zeros(table.shape)
        place = used["lang"].map({g: i for i, g in enumerate(languages)}).to_numpy(np.int64)
        sums[used["piece"].to_numpy(np.int64), place] = used["uses"].to_numpy(np.float64) / UNIT
        general = (sums.sum(axis=1) + 1.0) / (sums.sum() + len(pieces))
        table = (sums + SMOOTHING * general[:, None]) / (sums.sum(axis=0) + SMOOTHING)[None, :]
    whole = sum(texts.values())
    return Model(pieces, languages, np.array([texts[g] / whole for g in languages]), table)


def _sliced(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in runs of a bounded number of characters, a longer text alone."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= TEXT_CHARS or i + 1 == len(texts):
            yield texts[at:i + 1]
            at, size = i + 1, 0


def _scorer(shared):
    """Per text the best language of one model, its log probability, and that of all its languages together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known: dict[str, int] = {}
        scores = np.zeros((0, len(model.languages)))
        prior = np.log(model.shares)
        for batch in batches:
            best, top, every = [], [], []
            for texts in _sliced(batch.column(1).to_pylist()):
                found = [words_of(t) for t in texts]
                if len(known) > KNOWN_WORDS:
                    known, scores = {}, scores[:0]
                new = list(set().union(*found).difference(known))
                known.update(zip(new, range(len(known), len(known) + len(new))))
                scores = np.concatenate([scores, word_scores(new, model.pieces, model.table)])
                for words in found:
                    if not words:
                        best.append(None)
                        top.append(None)
                        every.append(None)
                        continue
                    places = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                    log = prior + scores[places].sum(axis=0)
                    i = int(log.argmax())
                    best.append(model.languages[i])
                    top.append(float(log[i]))
                    every.append(float(log[i] + np.log(np.exp(log - log[i]).sum())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(top, pa.float64()), pa.array(every, pa.float64())],
                names=["_row", "lang_pred", "top", "every"])

    return run


def identify(df: DataFrame, models: list[Model], text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``_row`` (the columns of ``df``, or those to ``carry``), ``lang_pred`` and ``score`` for each row.

    ``score`` is the language's share of the probability of the text over all languages, from 0 to 1, rounded to
    nine places. A text that is NULL or has no letter is ``und`` with score 0, and so is every text if no language
    was learnt. Of equal languages the first by name is taken. Repeated rows are told the same; an empty table
    gives no rows; names cannot clash, as the columns stay in ``_row``. Only the text is looked at.
    """
    spark = df.sparkSession
    kept = df.columns if carry is None else carry
    rows = df.select(F.struct(*[named(df, c) for c in kept]).alias("_row"), named(df, text_col).cast("string").alias("_text"))
    if not models:
        return rows.select("_row", F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"))

    def scored(model: Model, row: T.StructField, df: DataFrame) -> DataFrame:
        schema = T.StructType([row, T.StructField("lang_pred", T.StringType()), T.StructField("top", T.DoubleType()), T.StructField("every", T.DoubleType())])
        return df.mapInArrow(_scorer(spark.sparkContext.broadcast(model)), schema)

    def told(found: DataFrame) -> DataFrame:
        return found.select("_row", F.coalesce("lang_pred", F.lit(NONE)).alias("lang_pred"),
                            F.when(F.col("lang_pred").isNull(), 0.0).otherwise(
                                F.round(F.least(F.lit(1.0), F.exp(F.col("top") - F.col("every"))), 9)).alias("score"))

    if len(models) == 1:
        return told(scored(models[0], rows.schema["_row"], rows))
    # More languages than fit at once: each text's best of every turn, then the best of these.
    texts = stage(rows.withColumn("rid", F.monotonically_increasing_id()), "texts")
    turns = [stage(scored(m, T.StructField("_row", T.LongType()), texts.select("rid", "_text")), "turn") for m in models]
    every = turns[0]
    for t in turns[1:]:
        every = every.unionByName(t)
    most = every.groupBy("_row").agg(
        F.max_by("lang_pred", F.struct("top", F.hash("lang_pred"))).alias("lang_pred"), F.max("top").alias("top"), F.max("every").alias("high"))
    sums = every.join(most.select("_row", "high"), "_row").groupBy("_row").agg(F.sum(F.exp(F.col("every") - F.col("high"))).alias("s"))
    best = most.join(sums, "_row").select(F.col("_row").alias("rid"), "lang_pred", "top", (F.col("high") + F.log("s")).alias("every"))
    return told(texts.select("rid", "_row").join(best, "rid"))
