"""Files of token ids, coded by Simple-8b (see simple8b.py), in ascending doc_id order.

Documents are dealt into ranges of doc_id; the task of a range tokenizes them in order and writes one file:

    magic "S8BIDS1\\n" | blocks | documents: ids and lengths, 8 bytes each | offsets of the blocks, 8 bytes each |
    footer: end of blocks, documents, blocks, ids in total, 8 bytes each, magic

A document may span blocks; its place follows from the lengths before it, and the offsets lead straight to the blocks it needs.
The names of files belong to attempts, and only those that the written table of files lists are part of the output, so a task
may be lost and repeated. The folder must be one that all executors share. A null text is empty; documents of null id come first,
repeated rows are all written, equal ids in the order of their texts.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.llm.common import batches, crc, pack_ids, strings, table
from pluvio.llm.simple8b import BLOCK, decode_block, encode_blocks
from pluvio.llm.tokens import encoder, path_of
from pluvio.session import shared_folder, stage

MAGIC = b"S8BIDS1\n"
FOOT = struct.Struct("<qqqq8s")
NULL_ID = -(1 << 63)
END_ID = 2
DOCS_PER_FILE = 8000
#: Ids coded at once.
HELD = 1 << 18


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class Writer:
    def __init__(self, out):
        self.out, self.at = out, len(MAGIC)
        out.write(MAGIC)
        self.held: list[np.ndarray] = []
        self.n_held = self.total = 0
        self.docs: list[int] = []
        self.lengths: list[int] = []
        self.offsets: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(NULL_ID if doc_id is None else doc_id)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= HELD:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        values = np.concatenate([np.zeros(0, np.uint64), *self.held]).astype(np.uint64)
        whole = len(values) if last else len(values) // BLOCK * BLOCK
        for block in encode_blocks(values[:whole]):
            self.offsets.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.total += whole
        self.held, self.n_held = [values[whole:]], len(values) - whole

    def close(self) -> None:
        self._flush(True)
        self.out.write(np.array(self.docs, "<i8").tobytes() + np.array(self.lengths, "<i8").tobytes() + np.array(self.offsets, "<i8").tobytes())
        self.out.write(FOOT.pack(self.at, len(self.docs), len(self.offsets), self.total, MAGIC))


class Reader:
    def __init__(self, file):
        self.file = file
        size = file.size()
        self.end, n_docs, n_blocks, self.total, magic = FOOT.unpack(file.read_at(FOOT.size, size - FOOT.size))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        tables = np.frombuffer(file.read_at(8 * (2 * n_docs + n_blocks), self.end), "<i8")
        self.docs, self.lengths, self.offsets = tables[:n_docs], tables[n_docs:2 * n_docs], tables[2 * n_docs:]
        self.bounds = np.append(self.offsets, self.end)

    def blocks(self, first: int, last: int) -> Iterator[np.ndarray]:
        data = self.file.read_at(int(self.bounds[last] - self.bounds[first]), int(self.bounds[first]))
        for k in range(first, last):
            yield decode_block(data, int(self.bounds[k] - self.bounds[first]))

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document alone."""
        start = int(self.lengths[:k].sum())
        end = start + int(self.lengths[k])
        first = start // BLOCK
        got = np.concatenate([np.zeros(0, np.uint64), *self.blocks(first, -(-end // BLOCK))])
        return got[start - first * BLOCK:end - first * BLOCK].astype(np.uint32)

    def documents(self, step: int = 64) -> Iterator[tuple[int, int | None, np.ndarray]]:
        """Start, doc_id and ids of every document, some blocks at a time."""
        held, begin, at, k = np.zeros(0, np.uint32), 0, 0, 0
        for first in range(0, len(self.offsets), step):
            fresh = [b.astype(np.uint32) for b in self.blocks(first, min(first + step, len(self.offsets)))]
            held, begin = np.concatenate([held[at - begin:], *fresh]), at
            while k < len(self.docs) and at + self.lengths[k] <= begin + len(held):
                n = int(self.lengths[k])
                yield at, None if self.docs[k] == NULL_ID else int(self.docs[k]), held[at - begin:at - begin + n]
                at, k = at + n, k + 1


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, docs_per_file: int = DOCS_PER_FILE) -> DataFrame:
    """Write all documents; returns the table of files: shard (ascending with doc_id), path, n_docs, n_tokens."""
    if "://" not in folder:
        folder = f"file://{folder}"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    files = max(1, -(-docs.count() // docs_per_file))

    def written(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, writer, out, uri = encoder(path), None, None, ""
        end = np.array([end_id], np.uint32)
        for part in parts:
            if not part.num_rows:
                continue
            if writer is None:
                shard = TaskContext.get().partitionId()
                uri = f"{folder}/{shard:08d}-{uuid.uuid4().hex}.s8b"
                system, name = _place(uri)
                system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                out = system.open_output_stream(name)
                writer = Writer(out)
            for doc_id, ids in zip(part.column(0).to_pylist(), enc.encode(strings(part.column(1))), strict=True):
                writer.add(doc_id, np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([uri]), pa.array([len(writer.docs)], pa.int64()), pa.array([writer.total], pa.int64())],
                names=["shard", "path", "n_docs", "n_tokens"])

    dealt = docs.repartitionByRange(files, F.asc_nulls_first("doc_id"), F.xxhash64("text")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    return stage(batches(dealt, written, "shard long, path string, n_docs long, n_tokens long"), "id-files")


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    listed = files.select("path", "shard", F.coalesce(before, F.lit(0)).alias("before"))  # a row per file

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for uri, _, base in zip(*(c.to_pylist() for c in part.columns), strict=True):
                system, name = _place(uri)
                with system.open_input_file(name) as file:
                    rows: tuple[list, ...] = ([], [], [], [])
                    for start, doc_id, ids in Reader(file).documents():
                        for column, value in zip(rows, (doc_id, base + start, len(ids), crc(pack_ids(ids))), strict=True):
                            column.append(value)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, files.count())
    return batches(listed.repartition(n, "shard"), found, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    return read(write(table(spark, sf_dir, "documents"), folder, path_of("byte_bpe_50k.json")))
