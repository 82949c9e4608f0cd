"""Documents in bounded blocks, and a keyed count exchange between blocks.

Corpus-wide statistics over word windows would be one shuffle row per word.
Here a block of documents first reduces its windows to a sorted set of 64-bit
keys; the keys travel as one packed array per (block, bucket), a bucket task
merges the arrays of all blocks, and the answers travel back aligned with the
keys of each block. A key that is in a third of all documents is one entry per
block, so no task meets a hot key; buckets are ranges of the hash space, and
their number follows from the number of keys, so a task's memory is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.words import release_memory, text_buffers, word_spans
from pluvio.session import persist_table

BLOCK_SCHEMA = "block long, n_docs long, n_words long, docs binary"
MESSAGE_SCHEMA = "block long, bucket int, payload binary"


def pack_batch(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema,
                           options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_batch(blob: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(blob) as r:
        return r.read_all().combine_chunks().to_batches()[0]


def pack_array(a: np.ndarray) -> bytes:
    """Integers as byte planes under zstd: equal high bytes cost nothing."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
    return a.dtype.char.encode() + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_array(b: bytes) -> np.ndarray:
    dtype = np.dtype(b[:1].decode())
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(dtype.itemsize, -1).T).view(dtype).ravel()


def pack_pair(a: np.ndarray, b: np.ndarray) -> bytes:
    x = pack_array(a)
    return len(x).to_bytes(8, "little") + x + pack_array(b)


def unpack_pair(p: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(p[:8], "little")
    return unpack_array(p[8:8 + n]), unpack_array(p[8 + n:])


def document_blocks(docs: DataFrame, column: str = "text",
                    block_bytes: int = 4 << 20) -> DataFrame:
    """One row per block of whole documents (at least one; up to ``block_bytes``
    of text otherwise), all columns kept, written to the shared folder."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0

        def flush():
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            spans, _, _ = word_spans(*text_buffers(rows.column(rows.schema.get_field_index(column))))
            words = len(spans) + rows.num_rows
            return pa.RecordBatch.from_pydict(
                {"block": [base + n], "n_docs": [rows.num_rows], "n_words": [words],
                 "docs": [pack_batch(rows)]},
                schema=pa.schema([("block", pa.int64()), ("n_docs", pa.int64()),
                                  ("n_words", pa.int64()), ("docs", pa.binary())]))

        for batch in batches:
            if batch.num_rows == 0:
                continue
            _, off = text_buffers(batch.column(batch.schema.get_field_index(column)))
            i = 0
            while i < batch.num_rows:
                j = int(np.searchsorted(off, off[i] + block_bytes - size, side="right")) - 1
                j = min(max(j, i + (not held)), batch.num_rows)
                if j > i:
                    held.append(batch.slice(i, j - i))
                    size += int(off[j] - off[i])
                if j < batch.num_rows or size >= block_bytes:
                    yield flush()
                    held, size, n = [], 0, n + 1
                i = j
        if held:
            yield flush()
        held = []
        release_memory()

    return persist_table(docs.mapInArrow(build, BLOCK_SCHEMA), "blocks")


def bucket_bounds(blocks: DataFrame, keys_per_word: float, keys_per_bucket: int) -> int:
    """Number of buckets for the expected number of keys (one row to the driver)."""
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    return max(1, int(np.ceil(words * keys_per_word / keys_per_bucket)))


def by_bucket(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Cut positions of ascending keys at equal ranges of the hash space."""
    cuts = [(i << 64) // n_buckets for i in range(1, n_buckets)]
    inner = np.searchsorted(keys, np.array(cuts, dtype=np.uint64)) if cuts else []
    return np.concatenate([[0], inner, [len(keys)]]).astype(np.int64)


def runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[list[dict]]:
    """Consecutive rows with equal key columns of sorted batches, as one list."""
    held, at = [], None
    for batch in batches:
        for row in batch.to_pylist():
            k = tuple(row[c] for c in key)
            if held and k != at:
                yield held
                held = []
            at = k
            held.append(row)
    if held:
        yield held


def messages(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    block, bucket, payload = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(block, pa.int64()), pa.array(bucket, pa.int32()), pa.array(payload, pa.binary())],
        names=["block", "bucket", "payload"])


def answers(blocks: DataFrame, ask: Callable[[int, pa.RecordBatch], list[tuple[int, bytes]]],
            answer: Callable[[int, list[tuple[int, bytes]]], list[tuple[int, bytes]]]) -> DataFrame:
    """``ask`` turns a block into (bucket, payload) messages; ``answer`` merges a
    bucket's (block, payload) messages into (block, payload) answers. Returns
    ``(block, bucket, payload)``; answers to block -1 are totals."""

    def asking(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield messages([(row["block"], bucket, payload)
                                for bucket, payload in ask(row["block"], unpack_batch(row["docs"]))])

    def answering(batches):
        for rows in runs(batches, ["bucket"]):
            bucket = rows[0]["bucket"]
            yield messages([(block, bucket, payload) for block, payload in
                            answer(bucket, [(r["block"], r["payload"]) for r in rows])])

    asked = blocks.select("block", "docs").mapInArrow(asking, MESSAGE_SCHEMA)
    return asked.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(
        answering, MESSAGE_SCHEMA)


def with_answers(blocks: DataFrame, answered: DataFrame,
                 finish: Callable[[pa.RecordBatch, list[bytes]], Iterator[pa.RecordBatch]],
                 schema) -> DataFrame:
    """``finish`` gets a block's documents with its answers in bucket order."""

    def finishing(batches):
        for rows in runs(batches, ["block"]):
            yield from finish(unpack_batch(rows[0]["payload"]), [r["payload"] for r in rows[1:]])

    own = blocks.select("block", F.lit(-1).alias("bucket"), F.col("docs").alias("payload"))
    return (own.union(answered.where("block >= 0")).repartition("block")
            .sortWithinPartitions("block", "bucket").mapInArrow(finishing, schema))
