"""N-gram language-model scores by a weighted backoff automaton.

Counts come from all training documents: every block of documents reduces its
n-grams to sorted keys with counts, hash-range buckets add them up over all
blocks, and each block gets back the corpus counts of its own n-grams. From
these it builds the part of the automaton that its documents can reach: a
numbered state per seen history, an arc per seen n-gram with its target state,
and a failure arc to the state of the next shorter history. One left-to-right
pass per document carries the state from token to token and adds up the
log-probabilities of the arcs it takes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.blocks import (answers, bucket_bounds, by_bucket, document_blocks, pack_array,
                               pack_pair, unpack_array, unpack_pair, with_answers)
from pluvio.llm.words import batch_words, mix64
from pluvio.session import persist_table

KEYS_PER_BUCKET = 1_500_000
_END, _START = np.uint64(0x51ED270B9F3A1C35), np.uint64(0xC2B2AE3D27D4EB4F)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Sequences:
    """Tokens of a batch: 64-bit token keys, each document's first token (n + 1
    entries), and the n-gram keys ending at each token by order (0: none)."""

    first: np.ndarray
    grams: list[np.ndarray]

    @property
    def heads(self) -> np.ndarray:
        return self.first[:-1]


def sequences(texts: pa.Array, order: int) -> Sequences:
    """Words (A-Z folded) plus one end token per document. Keys of single tokens
    are odd, those of longer n-grams even; an n-gram may begin with the start."""
    words = batch_words(texts, fold_case=True)
    n = words.counts()
    first = np.concatenate([[0], np.cumsum(n + 1)])
    token = np.empty(int(first[-1]), np.uint64)
    end = np.zeros(len(token), bool)
    end[first[1:] - 1] = True
    token[~end], token[end] = words.hashes, _END
    token |= np.uint64(1)
    grams = [token]
    with np.errstate(over="ignore"):
        history = np.empty_like(token)
        for m in range(2, order + 1):
            history[1:] = grams[-1][:-1]
            history[first[:-1]] = _START if m == 2 else 0
            key = mix64(history * _STEP + token + np.uint64(m)) & ~np.uint64(1)
            grams.append(np.where(history == 0, np.uint64(0), key))
    return Sequences(first, grams)


@dataclass(frozen=True)
class Totals:
    tokens: int
    types: int
    once: int


class BackoffAutomaton:
    """The automaton over one block's n-grams.

    State 0 has no history; the last state is the start of a document; the others
    are the block's n-grams of fewer than ``order`` tokens. A seen n-gram ``h w`` is
    an arc from ``h`` under ``w`` of weight ``log10 (c(h w) + strength * P(w | h')) /
    (c(h) + strength)``; its target is the longest history that ends with it. The
    failure arc of ``h`` costs ``log10 strength / (c(h) + strength)`` and leads to
    ``h'``, the history without its first token. State 0 has an arc for every token
    of the block: a known one costs its count's share, scaled to leave the mass of
    tokens seen once to the one unknown token. Each state's outgoing probabilities
    sum to 1 over the known types and the unknown one.

    ``counts`` are the corpus counts of the block's distinct n-grams, by key.
    """

    def __init__(self, s: Sequences, counts: np.ndarray, totals: Totals, documents: int, strength: float):
        order = len(s.grams)
        every, at, node = np.unique(np.concatenate(s.grams), return_index=True, return_inverse=True)
        if len(every) and every[0] == 0:  # places before the first n-gram of an order
            counts = np.concatenate([[0], counts])
        number = node.reshape(order, -1) + 1  # states of n-grams count from 1
        start = len(every) + 1
        count = np.concatenate([[totals.tokens], counts, [documents]]).astype(np.int64)
        before = np.empty((order, number.shape[1]), np.int64)  # history of each place's n-gram
        before[0] = 0
        if order > 1:
            before[1:, 1:] = number[:-1, :-1]
            before[1, s.heads] = start
        m, place = np.divmod(at, max(number.shape[1], 1))  # an n-gram's order less one, and where it first stands
        history, token = before[m, place], number[0, place]
        shorter = np.where(m > 0, number[np.maximum(m - 1, 0), place], 0)

        unknown = max(totals.once, 1) / (totals.tokens + 1)
        probability = np.zeros(len(count))
        one = m == 0
        own = np.arange(len(every)) + 1
        probability[own[one]] = np.where(count[own[one]] > 0, (1 - unknown) * count[own[one]] / max(totals.tokens, 1),
                                         unknown)
        for k in range(1, order):
            i = np.flatnonzero((m == k) & (every != 0))
            probability[own[i]] = (count[own[i]] + strength * probability[shorter[i]]) / (count[history[i]] + strength)

        arc = np.flatnonzero(one | ((count[own] > 0) & (every != 0)))
        # the state reached: the n-gram itself as a history if it is seen and short enough
        reached = np.where(m < order - 1, own, shorter)
        reached = np.where(count[own] > 0, reached, 0)
        self.width = start + 1
        self.start = start if order > 1 else 0
        self.arcs = dict(zip((history[arc] * self.width + token[arc]).tolist(), range(len(arc))))
        self.weight = np.log10(probability[own[arc]]).tolist()
        self.target = reached[arc].tolist()
        self.failure = [0, *shorter.tolist(), 0]
        self.penalty = np.log10(strength / (count + strength)).tolist()
        self.tokens = number[0]
        self.seen = count[self.tokens]

    def traverse(self, first: np.ndarray) -> np.ndarray:
        """log10 probability of each document: one pass over its tokens that carries
        the state; ``first`` are the documents' first tokens (one entry more)."""
        arcs, weight, target = self.arcs, self.weight, self.target
        failure, penalty, width = self.failure, self.penalty, self.width
        scores = np.empty(len(first) - 1)
        for d, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            state, total = self.start, 0.0
            for token in self.tokens[lo:hi].tolist():
                arc = arcs.get(state * width + token)
                while arc is None:
                    total += penalty[state]
                    state = failure[state]
                    arc = arcs.get(state * width + token)
                total += weight[arc]
                state = target[arc]
            scores[d] = total
        return scores


def _corpus_counts(blocks: DataFrame, order: int, n_buckets: int) -> DataFrame:
    def ask(block: int, docs: pa.RecordBatch) -> list[tuple[int, bytes]]:
        s = sequences(docs.column("text"), order)
        learn = np.repeat(~np.asarray(docs.column("held_out")), np.diff(s.first))
        every = np.concatenate(s.grams)
        keys, inverse = np.unique(every, return_inverse=True)
        count = np.bincount(inverse, weights=np.tile(learn, order), minlength=len(keys)).astype(np.uint32)
        if len(keys) and keys[0] == 0:
            keys, count = keys[1:], count[1:]
        cut = by_bucket(keys, n_buckets)
        return [(i, pack_pair(np.diff(keys[lo:hi], prepend=np.uint64(0)), count[lo:hi]))
                for i, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])) if hi > lo]

    def answer(bucket: int, rows: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
        parts = [unpack_pair(p) for _, p in rows]
        each = [np.cumsum(d, dtype=np.uint64) for d, _ in parts]
        keys, inverse = np.unique(np.concatenate(each), return_inverse=True)
        count = np.bincount(inverse, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
        single = count[(keys & np.uint64(1)).astype(bool)]
        totals = np.array([single.sum(), (single > 0).sum(), (single == 1).sum()], dtype=np.int64)
        size = np.cumsum([len(k) for k in each])[:-1]
        return [(-1, totals.tobytes()),
                *((block, pack_array(c)) for (block, _), c in zip(rows, np.split(count[inverse], size)))]

    return answers(blocks, ask, answer)


def _totals(answered: DataFrame) -> Totals:
    """Sums over the buckets (one row each); three numbers reach the driver."""
    def number(i: int):
        octets = [F.conv(F.hex(F.substring("payload", 8 * i + b + 1, 1)), 16, 10).cast("long") * (1 << (8 * b))
                  for b in range(7)]
        return F.sum(sum(octets[1:], octets[0])).alias(f"n{i}")
    r = answered.where("block = -1").agg(*[number(i) for i in range(3)]).first()
    return Totals(*(int(v or 0) for v in r))


def lm_scores(docs: DataFrame, order: int = 2, strength: float = 300.0,
              folds: int = 7, held_fold: int = 2) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``.

    The model learns from all rows whose ``crc32(doc_id as text) mod folds`` is
    not ``held_fold`` and scores every row. ``base_score`` is the add-one
    unigram score, ``score`` the automaton's, both log10. Null text counts as
    empty and has the end token only; rows without ``doc_id`` are learned from;
    repeated rows count each; other columns are ignored; an empty table gives an
    empty result. Tokens and n-grams are identified by 64-bit hashes.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_fold, F.lit(False))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held)
    blocks = document_blocks(d)
    learned = d.where("not held_out").count()
    answered = persist_table(
        _corpus_counts(blocks, order, bucket_bounds(blocks, float(order), KEYS_PER_BUCKET)), "counts")
    totals = _totals(answered)

    def finish(batch: pa.RecordBatch, got: list[bytes]) -> Iterator[pa.RecordBatch]:
        s = sequences(batch.column("text"), order)
        automaton = BackoffAutomaton(s, np.concatenate([unpack_array(p) for p in got]), totals, learned, strength)
        score, count = automaton.traverse(s.first), automaton.seen
        base = np.log10((count + 1) / (totals.tokens + totals.types + 1))
        add = lambda x: np.add.reduceat(x, s.heads)
        n = np.diff(s.first)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column("held_out"), pa.array(n, pa.int64()),
             pa.array(add((count > 0).astype(np.int64)), pa.int64()),
             pa.array(np.full(len(n), totals.tokens), pa.int64()), pa.array(add(base)), pa.array(score)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return with_answers(blocks, answered, finish,
                        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                        "base_score double, score double")
