"""Pack token ids of documents into fixed-length sequences.

Shortest-pack-first over the length histogram: only the histogram of piece
lengths (at most ``seq_len`` rows, whatever the corpus) reaches the driver. It
becomes packing patterns with repeat counts; a piece finds its place by its
rank among the pieces of its length, so the plan is joined back by rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.token_files import id_lists, with_end
from pluvio.llm.tokenizing import SLICE_BYTES, encoder
from pluvio.llm.words import slices
from pluvio.session import persist_table

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "part int, part_rank long")


def pack_patterns(histogram: dict[int, int], seq_len: int) -> list[tuple[tuple[int, ...], int]]:
    """Shortest-pack-first: lengths from the longest down; the copies of a length
    go to the packs that have the least used so far, as long as they fit, else
    they open new packs. Equal packs are one pattern with a count, so the work
    depends on the histogram and not on the documents."""
    by_room: dict[int, dict[tuple[int, ...], int]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for room in range(seq_len - 1, length - 1, -1):  # least used packs first
            while left and by_room.get(room):
                pattern, count = by_room[room].popitem()
                use = min(left, count)
                if use < count:
                    by_room[room][pattern] = count - use
                _add(by_room, room - length, (*pattern, length), use)
                left -= use
            if not left:
                break
        if left:
            _add(by_room, seq_len - length, (length,), left)
    return sorted((p, n) for packs in by_room.values() for p, n in packs.items())


def _add(by_room: dict, room: int, pattern: tuple[int, ...], count: int) -> None:
    packs = by_room.setdefault(room, {})
    packs[pattern] = packs.get(pattern, 0) + count


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length the places for its pieces in rank order: columns
    (first rank, sequence of that rank, offset); later ranks of a row take the
    following sequences. The size depends on the patterns only."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rows.setdefault(length, []).append((used.get(length, 0), base, offset))
            used[length] = used.get(length, 0) + count
            offset += length
        base += count
    return {length: np.array(r, dtype=np.int64) for length, r in rows.items()}


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, seq_len: int = 2048,
               keep_ids: bool = True) -> DataFrame:
    """Encode documents and cut each into full sequences plus one rest.

    Null text counts as empty (its only id is ``end_id``); rows without
    ``doc_id`` and repeated ids are packed like any other; other columns are
    ignored. Each piece gets its rank among the pieces of its length within its
    input partition. Written to the shared folder, so ranks are fixed once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seen = encoder(tokenizer, False), TaskContext.get().partitionId(), {}
        for rows in slices(batches, max_bytes=SLICE_BYTES):
            out, ids = [], []
            flat, ends = with_end(*enc.encode_column(rows.column(1)), end_id)
            raw, ends = flat.tobytes(), ends.tolist()
            for doc_id, lo, hi in zip(rows.column(0).to_pylist(), ends[:-1], ends[1:]):
                total = hi - lo
                for start in range(0, total, seq_len):
                    n = min(seq_len, total - start)
                    piece = raw[4 * (lo + start):4 * (lo + start + n)]
                    rank = seen.get(n, 0)
                    seen[n] = rank + 1
                    out.append((doc_id, start, n, zlib.crc32(piece), total, part, rank))
                    if keep_ids:
                        ids.append(piece)
            cols = [pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "part_rank"]
            if keep_ids:
                cols.append(id_lists(ids))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = PIECE_SCHEMA + (", ids array<int>" if keep_ids else "")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return persist_table(d.mapInArrow(cut, schema), "pieces")


def place_pieces(pieces: DataFrame, seq_len: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of :func:`cut_pieces`.

    Rank among all pieces of a length = pieces of that length in earlier input
    partitions (a sum over the small (partition, length) counts) + rank within
    the partition, so a hot length is never gathered anywhere."""
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = persist_table(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    place = slots(pack_patterns(histogram, seq_len))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (pieces.join(base, ["part", "length"])
              .select(*[c for c in pieces.columns if c not in ("part", "part_rank")],
                      (F.col("base") + F.col("part_rank")).alias("rank")))
    fields = [f for f in ranked.schema.fields if f.name != "rank"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = np.asarray(b.column("length"))
            rank = np.asarray(b.column("rank"))
            seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                at = length == n
                rows = place[int(n)]
                i = np.searchsorted(rows[:, 0], rank[at], side="right") - 1
                seq[at] = rows[i, 1] + rank[at] - rows[i, 0]
                off[at] = rows[i, 2]
            yield pa.RecordBatch.from_arrays(
                [b.column(f.name) for f in fields] + [pa.array(seq), pa.array(off)],
                names=[f.name for f in fields] + ["sequence_id", "offset"])

    return ranked.mapInArrow(assign, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, seq_len: int = 2048,
                   keep_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, with ``keep_ids``, ``ids``."""
    return place_pieces(cut_pieces(docs, tokenizer, end_id, seq_len, keep_ids), seq_len)


def packed_sequences(placed: DataFrame, pad_id: int = 0, seq_len: int = 2048) -> DataFrame:
    """``(sequence_id, ids, n_used)``: the pieces of each sequence in order,
    padded to ``seq_len`` unless the used length is a power of two. A sequence
    holds at most ``seq_len`` pieces, so the groups are bounded."""
    s = placed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"),
        F.sum("length").cast("int").alias("n_used"))
    used = F.col("n_used")
    pad = F.when(used.bitwiseAND(used - 1) == 0, F.lit(0)).otherwise(F.lit(seq_len) - used)
    return s.select("sequence_id", F.concat(F.flatten(F.col("p.ids")),
                                            F.array_repeat(F.lit(pad_id), pad)).alias("ids"), "n_used")
