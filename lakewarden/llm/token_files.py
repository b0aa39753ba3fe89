"""Token ids in files of fixed-width packed bits.

Every id takes the least number of bits that the vocabulary needs. Eight ids fill a whole number of bytes,
so a file is packed and unpacked by a few numpy operations per lane. Ids come in blocks of ``BLOCK``; the file
lists where each block starts, so that a range of ids is read without the rest.

A file: MAGIC, then five 64-bit numbers (bits, ids a block, ids, documents, blocks), the block offsets, per
document its id, whether that is NULL, and the place of its first id, then the blocks.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import pick
from lakewarden.llm.tokens import END_ID, encoder, vocabulary_size
from lakewarden.session import shared_path, stage

MAGIC = b"TOKBITS1"
BLOCK = 1024
# A file is closed once it holds this many ids, so that one is read in bounded memory.
FILE_IDS = 4_000_000
# Reading tasks, where there are more files than that.
TASKS_PER_CORE = 32
_HEAD = struct.Struct("<5Q")


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids, padded with 0 to whole blocks, in ``bits`` bits each, lowest bit first."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit {bits} bits")
    lanes = np.zeros((-(-len(ids) // BLOCK) * BLOCK // 8, 8), np.uint64)
    lanes.reshape(-1)[:len(ids)] = ids
    out = np.zeros((len(lanes), bits + 8), np.uint8)
    for lane in range(8):
        first, shift = divmod(lane * bits, 8)
        value = lanes[:, lane] << np.uint64(shift)
        for k in range((bits + shift + 7) // 8):
            out[:, first + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out[:, :bits].tobytes()


def unpack_ids(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed blocks."""
    packed = np.frombuffer(data, np.uint8).reshape(-1, bits)
    out = np.empty((len(packed), 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(8):
        first, shift = divmod(lane * bits, 8)
        value = np.zeros(len(packed), np.uint64)
        for k in range((bits + shift + 7) // 8):
            value |= packed[:, first + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:count]


def file_bytes(doc_ids: list[int | None], ids: list[bytes], bits: int) -> bytes:
    """One file from documents in order, each with its little-endian 32-bit ids."""
    lengths = np.array([len(x) // 4 for x in ids], np.uint64)
    flat = np.frombuffer(b"".join(ids), "<u4")
    n_blocks = -(-len(flat) // BLOCK)
    starts = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lengths)[:-1]]) if len(ids) else lengths
    head = MAGIC + _HEAD.pack(bits, BLOCK, len(flat), len(ids), n_blocks)
    base = len(head) + 8 * n_blocks + 17 * len(ids)
    offsets = base + np.arange(n_blocks, dtype="<u8") * (BLOCK * bits // 8)
    names = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([head, offsets.astype("<u8").tobytes(), names.tobytes(), nulls.tobytes(),
                     starts.astype("<u8").tobytes(), pack_ids(flat, bits)])


class TokenFile:
    """A file opened for reading; only its index is held."""

    def __init__(self, path: str):
        system, place = fs.FileSystem.from_uri(path)
        self._file = system.open_input_file(place)
        if self._read(0, 8) != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.bits, self.block, self.n_ids, self.n_docs, n_blocks = _HEAD.unpack(self._read(8, _HEAD.size))
        at = 8 + _HEAD.size
        index = self._read(at, 8 * n_blocks + 17 * self.n_docs)
        self.offsets = np.frombuffer(index, "<u8", n_blocks)
        names = np.frombuffer(index, "<i8", self.n_docs, 8 * n_blocks)
        nulls = np.frombuffer(index, np.uint8, self.n_docs, 8 * n_blocks + 8 * self.n_docs)
        self.doc_ids = [None if n else int(d) for d, n in zip(names, nulls)]
        self.starts = np.frombuffer(index, "<u8", self.n_docs, 8 * n_blocks + 9 * self.n_docs).astype(np.int64)

    def _read(self, at: int, size: int) -> bytes:
        self._file.seek(at)
        return self._file.read(size)

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``end``, reading only the blocks that hold them."""
        end = self.n_ids if end is None else min(end, self.n_ids)
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        size = int(self.offsets[last] - self.offsets[first]) + self.block * self.bits // 8
        held = unpack_ids(self._read(int(self.offsets[first]), size), self.bits, (last - first + 1) * self.block)
        return held[start - first * self.block:end - first * self.block]

    def close(self) -> None:
        self._file.close()


def _writer(folder: str, tokenizer: str, bits: int, file_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        encode, end = encoder(tokenizer).encode, struct.pack("<I", END_ID)
        system, place = fs.FileSystem.from_uri(folder)
        system.create_dir(place, recursive=True)
        docs: list[int | None] = []
        ids: list[bytes] = []
        held = number = 0

        def close() -> pa.RecordBatch:
            # The attempt is part of the name: only files of the attempt whose rows are kept are read.
            name = f"{task.partitionId():08d}-{number:06d}-{task.taskAttemptId()}.bin"
            with system.open_output_stream(f"{place}/{name}") as out:
                out.write(file_bytes(docs, ids, bits))
            return pa.RecordBatch.from_pylist([{
                "part": task.partitionId(), "number": number, "path": f"{folder}/{name}",
                "n_docs": len(docs), "n_ids": held}], _MANIFEST_TYPE)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = encode(text) + end
                docs.append(doc_id)
                ids.append(data)
                held += len(data) // 4
                if held >= file_ids:
                    yield close()
                    docs, ids, held, number = [], [], 0, number + 1
        if docs:
            yield close()

    return write


_MANIFEST_TYPE = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("path", pa.string()),
                            ("n_docs", pa.int64()), ("n_ids", pa.int64())])
MANIFEST = "part long, number long, path string, n_docs long, n_ids long"


def write_token_files(df: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id",
                      text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Write all texts in ascending id order, each ended by id 0; returns the manifest, one row per file.

    Files of a failed or repeated attempt are not in the manifest. ``folder`` is any place that pyarrow's
    file systems reach from every executor; the default is a fresh one under ``spark.checkpoint.dir``.
    A NULL text counts as empty, NULL ids come first, repeated ids in the order of their texts' hashes, and an
    empty table gives an empty manifest. Columns other than the two named are not read.
    """
    folder = folder or shared_path(df.sparkSession, "tokens")
    bits = bits_for(max(vocabulary_size(tokenizer), END_ID + 1))
    rows = pick(df, id=id_col, text=text_col).select(F.col("id").cast("bigint").alias("id"), "text")
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("id").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("id").asc_nulls_first(), tie)
    manifest = stage(ordered.mapInArrow(_writer(folder, tokenizer, bits, file_ids), MANIFEST), "manifest")
    # Files are summed per part first, so that only one row per part meets in one task.
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("_ids")).select("part", F.coalesce(F.sum("_ids").over(
        before.orderBy("part")), F.lit(0)).alias("_earlier"))
    own = F.coalesce(F.sum("n_ids").over(before.partitionBy("part").orderBy("number")), F.lit(0))
    return manifest.withColumn("_own", own).join(parts, "part").withColumn(
        "first_id", (F.col("_own") + F.col("_earlier")).cast("bigint")).drop("_own", "_earlier")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            file = TokenFile(row["path"])
            ends = np.append(file.starts[1:], file.n_ids)
            flat = file.ids().astype("<u4")
            # A few documents at a time bound what is sent at once.
            for lo in range(0, file.n_docs, 256):
                span = range(lo, min(lo + 256, file.n_docs))
                yield pa.RecordBatch.from_arrays([
                    pa.array([file.doc_ids[i] for i in span], pa.int64()),
                    pa.array([row["first_id"] + int(file.starts[i]) for i in span], pa.int64()),
                    pa.array([flat[file.starts[i]:ends[i]].tobytes() for i in span], pa.binary()),
                ], names=["doc_id", "start", "ids"])
            file.close()


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document in the files; ids are little-endian unsigned 32-bit.

    One reading task for each file, up to ``TASKS_PER_CORE`` of them a core; an empty manifest gives no rows.
    """
    tasks = max(1, min(manifest.count(), TASKS_PER_CORE * manifest.sparkSession.sparkContext.defaultParallelism))
    return manifest.select("path", "first_id").repartition(tasks, "path").mapInArrow(
        _unpack, "doc_id long, start long, ids binary")
