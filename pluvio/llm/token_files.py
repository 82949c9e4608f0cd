"""Token ids of documents in Parquet files that allow selective reads.

Layout: one directory; files in ascending document order; one row per document
with ``doc_id``, ``part`` (number of the file's range), ``part_offset`` (ids of
the documents before it in that range), ``n_tokens`` and the list column
``ids``. Metadata columns are dictionary coded; ids are delta coded by default
(Parquet 2 pages, dictionary off for that column) or dictionary coded.
Row groups and pages are small enough, and column and offset indexes are
written, so a reader that filters on ``doc_id`` opens a few pages, and one that
asks for metadata never touches the ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.llm.tokenizing import SLICE_BYTES, encoder
from pluvio.llm.words import slices
from pluvio.session import scratch_path

FILE_SCHEMA = "doc_id long, part int, part_offset long, n_tokens long, ids array<int>"


def id_lists(parts: list[bytes]) -> pa.Array:
    """Little-endian id bytes of each row as an Arrow list column."""
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                    pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of texts with ``end_id`` after each text."""
    return np.insert(ids, ends[1:], end_id), ends + np.arange(len(ends))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, keep_space: bool, end_id: int,
                 coding: str = "delta", row_group_bytes: int = 16 << 20,
                 page_rows: int = 500, files: int | None = None) -> None:
    """Encode ``docs(doc_id, text)`` and write the id files under ``path``.

    Every document's ids end with ``end_id``. Null text counts as empty, rows
    without ``doc_id`` come first, repeated ids keep all their rows (ordered by
    text), other columns are ignored. An empty table writes an empty directory
    with the schema. Documents are dealt into ranges of ``doc_id`` (hot sources
    do not matter, ids are spread), so no task gathers more than its range.
    """
    if coding not in ("delta", "dictionary"):
        raise ValueError("coding is 'delta' or 'dictionary'")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, done = encoder(tokenizer, keep_space), TaskContext.get().partitionId(), 0
        for rows in slices(batches, max_bytes=SLICE_BYTES):
            ids, ends = with_end(*enc.encode_column(rows.column(1)), end_id)
            n = np.diff(ends)
            before = done + np.cumsum(n) - n
            done += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(before),
                 pa.array(n), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.view("<i4")))],
                names=["doc_id", "part", "part_offset", "n_tokens", "ids"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = files or int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (d.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(encode, FILE_SCHEMA).write
     .option("compression", "zstd")
     .option("parquet.writer.version", "v2")
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.page.row.count.limit", page_rows)
     .option("parquet.enable.dictionary", "true")
     .option("parquet.enable.dictionary#ids.list.element", str(coding == "dictionary").lower())
     .parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)``; ``start`` counts the ids of all
    documents before it. Only one row per file range is gathered for the
    offsets; columns that are not selected are not read."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    # one row per file: bounded by the number of files, not by the documents
    return (rows.join(F.broadcast(before), "part")
            .select("doc_id", (F.col("base") + F.col("part_offset")).alias("start"), "n_tokens", "ids"))


def ids_crc32(rows: DataFrame, column: str = "ids") -> DataFrame:
    """Replace an id list column by ``ids_crc32``: the unsigned crc32 of the ids
    as little-endian unsigned 32-bit integers."""
    keep = [f for f in rows.schema.fields if f.name != column]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ", ids_crc32 long"

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(b.schema.get_field_index(column))
            off = np.asarray(lists.offsets)
            raw = np.asarray(lists.values).astype("<u4").tobytes()
            sums = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(f.name) for f in keep] + [pa.array(sums, pa.int64())],
                names=[f.name for f in keep] + ["ids_crc32"])

    return rows.select(*[f.name for f in keep], column).mapInArrow(crc, schema)


def token_file_digest(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the id files to a new folder under the shared checkpoint folder, read
    them back and return ``(doc_id, start, n_tokens, ids_crc32)``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, keep_space=True, end_id=end_id)
    return ids_crc32(read_tokens(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")
