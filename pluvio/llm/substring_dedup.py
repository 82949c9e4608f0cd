"""Removal of word passages that repeat anywhere in the corpus.

Relative Lempel-Ziv parsing in blocks. The corpus is cut into blocks, and every
block is indexed as a reference: its index is the sorted set of 64-bit hashes of
its ``min_words``-word windows, the shortest factor that counts. The indexes are
merged by hash range, so each window of a document is looked up against every
reference block at once and learns the first block that holds it elsewhere. The
parse is greedy, left to right: a factor starts at the first word whose window
is found, takes that window's reference block and grows word by word while the
next window is in the same block; at a factor's end the windows that straddle it
are looked up like any other, so a passage whose copies lie in several blocks is
covered without a hole. All factors are at least ``min_words`` long and become
duplicate spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.blocks import (answers, bucket_bounds, by_bucket, document_blocks, pack_array,
                               pack_pair, unpack_array, unpack_pair, with_answers)
from pluvio.llm.words import batch_words, window_hashes

KEYS_PER_BUCKET = 1_500_000


def _references(blocks: DataFrame, column: str, min_words: int, n_buckets: int) -> DataFrame:
    """For each block and bucket, aligned with the block's ascending keys: 0 if
    the window is nowhere else, else 1 + the first other block that holds it (or
    the block itself, if only it does, twice or more)."""

    def ask(block: int, docs: pa.RecordBatch) -> list[tuple[int, bytes]]:
        hashes, _ = window_hashes(batch_words(docs.column(docs.schema.get_field_index(column))), min_words)
        keys, count = np.unique(hashes, return_counts=True)
        cut = by_bucket(keys, n_buckets)
        return [(i, pack_pair(np.diff(keys[lo:hi], prepend=np.uint64(0)), (count[lo:hi] > 1).astype(np.uint8)))
                for i, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])) if hi > lo]

    def answer(bucket: int, rows: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
        name = np.array([block for block, _ in rows], dtype=np.int64)
        parts = [unpack_pair(p) for _, p in rows]
        keys = [np.cumsum(d, dtype=np.uint64) for d, _ in parts]
        size = np.array([len(k) for k in keys])
        owner = np.repeat(np.arange(len(rows)), size)
        order = np.argsort(np.concatenate(keys), kind="stable")  # blocks ascend inside a key
        key, own = np.concatenate(keys)[order], owner[order]
        twice = np.concatenate([t for _, t in parts])[order].astype(bool)
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        held = np.diff(np.concatenate([start, [len(key)]]))
        group = np.repeat(np.arange(len(start)), held)
        first = own[start][group]
        second = own[np.minimum(start + 1, len(key) - 1)][group]
        other = np.where(own == first, second, first)
        found = np.where(held[group] > 1, name[other] + 1, np.where(twice, name[own] + 1, 0))
        aligned = np.empty(len(key), np.int64)
        aligned[order] = found
        return [(int(b), pack_array(a)) for b, a in zip(name, np.split(aligned, np.cumsum(size)[:-1]))]

    return answers(blocks, ask, answer)


def parse(first: np.ndarray, at: np.ndarray, reference: np.ndarray, size: int):
    """Factors ``(start word, words, reference block)`` of a batch, and the mask
    of the words that lie in a factor. ``at`` are the windows' first words,
    ``reference`` is 0 where a window is found nowhere else."""
    found = reference > 0
    own = np.searchsorted(first, at, side="right")  # a factor stays in its document
    begin = found.copy()
    begin[1:] &= ~(found[:-1] & (at[1:] == at[:-1] + 1) & (own[1:] == own[:-1])
                   & (reference[1:] == reference[:-1]))
    b = np.flatnonzero(begin)
    run = np.add.reduceat(found.astype(np.int64), b) if len(b) else b
    start, length = at[b], run + size - 1
    edge = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    return start, length, reference[b] - 1, np.cumsum(edge)[:-1] > 0


def _finish(column: str, size: int, outputs):
    def finish(docs: pa.RecordBatch, got: list[bytes]) -> Iterator[pa.RecordBatch]:
        words = batch_words(docs.column(docs.schema.get_field_index(column)))
        hashes, at = window_hashes(words, size)
        _, inverse = np.unique(hashes, return_inverse=True)
        known = np.concatenate([unpack_array(p) for p in got]) if got else np.zeros(0, np.int64)
        yield outputs(docs, words, *parse(words.first, at, known[inverse], size))
    return finish


def _kept_texts(words, covered: np.ndarray) -> list[str]:
    raw = words.data.tobytes()
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        keep = lo + np.flatnonzero(~covered[lo:hi])
        out.append(b" ".join([raw[s:e] for s, e in zip(words.start[keep].tolist(), words.end[keep].tolist())]).decode())
    return out


def _removed(words, covered: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(covered)])
    return sums[words.first[1:]] - sums[words.first[:-1]]


def _run(docs: DataFrame, column: str, min_words: int, outputs, schema) -> DataFrame:
    blocks = document_blocks(docs, column)
    n = bucket_bounds(blocks, 1.0, KEYS_PER_BUCKET)
    return with_answers(blocks, _references(blocks, column, min_words, n),
                        _finish(column, min_words, outputs), schema)


def repeated_spans(docs: DataFrame, min_words: int = 35) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text, factors)``, one row per input row.

    A word goes if a window of ``min_words`` words covers it whose word sequence
    also starts anywhere else, in the same document too; windows are judged on
    the input. Words are unchanged; ``kept_text`` joins those that stay by one
    space. ``factors``: start word, words and reference block of each duplicate
    span. Null and empty texts have no words; shorter texts lose none; null and
    repeated ``doc_id`` rows are documents of their own; other columns are
    ignored; an empty table gives an empty result. Windows are compared by
    64-bit hashes.
    """
    def outputs(batch, words, start, length, block, covered):
        doc = np.searchsorted(words.first, start, side="right") - 1
        cut = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
        inside = start - words.first[doc] if len(start) else start
        factors = pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays(
            [pa.array(inside, pa.int64()), pa.array(length, pa.int64()), pa.array(block, pa.int64())],
            names=["start", "words", "block"]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(words.counts(), pa.int64()), pa.array(_removed(words, covered), pa.int64()),
             pa.array(_kept_texts(words, covered), pa.string()), factors],
            names=["doc_id", "n_words", "n_removed", "kept_text", "factors"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _run(d, "text", min_words, outputs,
                "doc_id long, n_words long, n_removed long, kept_text string, "
                "factors array<struct<start: long, words: long, block: long>>")


def without_repeats(docs: DataFrame, min_words: int = 35) -> DataFrame:
    """``docs`` with the same columns; where words are removed, ``text`` is the
    kept words joined by one space, other rows are unchanged. A column
    ``n_chars`` of whole numbers follows the new text."""
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def outputs(batch, words, start, length, block, covered):
        gone = _removed(words, covered) > 0
        if not gone.any():
            return batch
        text = batch.column(at).to_pylist()
        kept = _kept_texts(words, covered)
        text = [k if g else t for t, k, g in zip(text, kept, gone.tolist())]
        cols = list(batch.columns)
        cols[at] = pa.array(text, batch.schema.field(at).type)
        if chars is not None and pa.types.is_integer(batch.schema.field(chars).type):
            n = [len(k) if g else v for v, k, g in zip(batch.column(chars).to_pylist(), kept, gone.tolist())]
            cols[chars] = pa.array(n, batch.schema.field(chars).type)
        return pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return _run(docs, "text", min_words, outputs, docs.schema)
