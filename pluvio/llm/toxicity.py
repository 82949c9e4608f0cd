"""Toxicity scores: boosted trees over dense text features, isotonic calibration.

The lexicon is learned from labelled training documents: words (and word
beginnings, so that other endings of a stem count too) that occur far more often
in toxic documents. A document becomes a short dense vector: lexicon densities,
hits near second-person words, capitals, punctuation and obfuscated spelling.
Gradient-boosted trees separate the classes; an isotonic fit on documents the
trees have not seen turns their margin into a probability.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.words import Words, batch_words, fold_ascii, hash_ranges, release_memory, slices
from pluvio.session import persist_table

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W\d_]+")
_CAPITAL = re.compile("[A-ZÀ-ÖØ-Þ]")

#: Digits and signs written for letters.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t",
                            "@": "a", "$": "s", "!": "i"})
#: Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen euch euer ihr ihnen "
    "tu te toi ton ta tes vous votre vos usted ustedes tú ti tuyo vuestro os".split())

FEATURES = ("log_words", "hits", "hit_density", "strong_density", "distinct_hits", "stem_density",
            "weight_mean", "weight_max", "near_second_person", "second_person_density",
            "capital_letters", "capital_words", "exclamations", "punctuation", "obfuscated",
            "obfuscated_hits", "neighbour_hits")
NEAR_WORDS = 5
STEMS = (4, 5, 6)


def plain_word(word: str) -> tuple[str, bool]:
    """Lower-case word without marks at its edges, and whether its spelling is
    obfuscated (signs or digits between letters); such a word is read with
    look-alikes replaced and the remaining signs dropped."""
    w = _EDGE.sub("", unicodedata.normalize("NFC", word)).lower()
    if w.isalpha() or not any(c.isalpha() for c in w):
        return w, False
    if "'" in w or "’" in w or "-" in w.strip("-"):
        joined = w.replace("'", "").replace("’", "").replace("-", "")
        if joined.isalpha():
            return w, False
    return _INNER.sub("", w.translate(LOOKALIKES)), True


def entries(word: str) -> list[str]:
    """Lexicon entries of a plain word: itself and its beginnings."""
    return [word, *(word[:n] + "~" for n in STEMS if len(word) > n)] if word else []


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """``(doc_id, toxic)`` of training rows: labelled, not held out, at most about
    ``bound`` of them, chosen by a hash of the id (all, if there are fewer)."""
    known = (labels.where("doc_id is not null and toxic is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
             .where(fold_of(F.col("doc_id")) != 0))
    known = persist_table(known, "labels")
    n = known.count()
    if n > bound:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < int((1 << 30) * bound / n))
    return known


def learn_lexicon(train: DataFrame, least_documents: int = 5, least_odds: float = 1.5) -> dict[str, float]:
    """Entries with their log odds of being in a toxic against another document.

    ``train`` has ``text`` and ``toxic``; in one pass every task counts in how many of
    its documents of either class an entry occurs. Entries of at least
    ``least_documents`` toxic documents and ``least_odds`` are the lexicon; their number
    is bounded by the bounded number of labelled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, int] = {}
        of_word: dict[int, list[int]] = {}
        found = np.zeros((2, 0), np.int64)

        def counts() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(numbers), pa.string()), *[pa.array(f[:len(numbers)]) for f in found]],
                names=["entry", "clean", "toxic"])

        for b in slices(batches):
            words = batch_words(b.column(0))
            doc = np.repeat(np.arange(b.num_rows), words.counts())
            distinct, at, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
            held = []
            raw = words.data.tobytes()
            for h, i in zip(distinct.tolist(), at.tolist()):
                e = of_word.get(h)
                if e is None:
                    word = raw[words.start[i]:words.end[i]].decode()
                    e = of_word[h] = [numbers.setdefault(x, len(numbers)) for x in entries(plain_word(word)[0])]
                held.append(e)
            if found.shape[1] < len(numbers):
                found = np.pad(found, ((0, 0), (0, 2 * len(numbers) - found.shape[1])))
            n_entries = np.array([len(e) for e in held] or [0], np.int64)
            flat = np.array([x for e in held for x in e], np.int64)
            first = np.concatenate([[0], np.cumsum(n_entries)])
            pair = np.unique(doc * max(1, len(distinct)) + inverse) if len(distinct) else np.zeros(0, np.int64)
            who, word = np.divmod(pair, max(1, len(distinct)))
            times = n_entries[word] if len(word) else word
            inner = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            each = np.unique(np.repeat(who, times) * max(1, len(numbers)) + flat[np.repeat(first[word], times) + inner])
            who, entry = np.divmod(each, max(1, len(numbers)))
            toxic = np.asarray(b.column(1)).astype(bool)
            for k in (0, 1):
                found[k] += np.bincount(entry[toxic[who] == bool(k)], minlength=found.shape[1])
            if len(numbers) > 300_000:
                yield counts()
                numbers, of_word, found = {}, {}, np.zeros((2, 0), np.int64)
        if numbers:
            yield counts()
        numbers, of_word = {}, {}
        release_memory()

    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return {}
    rows = train.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, "entry string, clean long, toxic long")
    odds = (F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1)))
    kept = (rows.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
            .where(F.col("toxic") >= least_documents).select("entry", odds.alias("odds")).where(F.col("odds") >= least_odds))
    return {r["entry"]: r["odds"] for r in kept.collect()}


def _hashes(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words]).astype(np.int64)
    return hash_ranges(np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends)


class _Lookup:
    """Values by the hash of an entry."""

    def __init__(self, values: dict[str, float]):
        keys = _hashes([k.encode() for k in values])
        order = np.argsort(keys)
        self._keys, self._values = keys[order], np.array(list(values.values()), float)[order]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self._keys):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self._keys, hashes), len(self._keys) - 1)
        return np.where(self._keys[at] == hashes, self._values[at], 0.0)


def _class(characters) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


_UPPER, _LOWER = _class(string.ascii_uppercase), _class(string.ascii_lowercase)
_MARKS = _class("!?.,;:*#$%&|")
_ALNUM = _UPPER | _LOWER | _class(string.digits)


class FeatureReader:
    """Dense features of texts for a given lexicon: sums of what each word adds, worked
    out once per distinct word of a slice. ASCII words of letters only or without any
    letter are looked up as arrays; the others, whose spelling has to be read, one by
    one, and remembered."""

    MAX_WORDS = 120_000

    def __init__(self, lexicon: dict[str, float]):
        self._lexicon = lexicon
        self._strong = 3.0
        self._whole = _Lookup({k: v for k, v in lexicon.items() if not k.endswith("~")})
        self._stems = [_Lookup({k[:-1]: v for k, v in lexicon.items() if k.endswith("~") and len(k) == n + 1}) for n in STEMS]
        self._second = _Lookup({w: 1.0 for w in SECOND_PERSON})
        self._known: dict[int, tuple] = {}

    def _word(self, word: str) -> tuple:
        """Weight as a whole word, as a beginning, second person, obfuscated, letters,
        capitals, whether in capitals; and the plain word if it has weight."""
        plain, hidden = plain_word(word)
        whole, *stems = entries(plain) or [""]
        weight, stem = self._lexicon.get(whole, 0.0), max((self._lexicon.get(s, 0.0) for s in stems), default=0.0)
        return (weight, stem, plain in SECOND_PERSON, hidden, sum(map(str.isalpha, word)), len(_CAPITAL.findall(word)),
                word.isupper() and len(word) > 1), plain.encode() if weight or stem else None

    def _distinct(self, words: Words, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A row per distinct word (as in :meth:`_word`, and its exclamation marks and
        marks) and the number of its plain word. ``at``: where it first occurs, ascending."""
        data, start, end = words.data, words.start[at], words.end[at]

        def count(mask: np.ndarray, lo=start, hi=end) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
            return sums[hi] - sums[lo]
        upper, lower, alnum = _UPPER[data], _LOWER[data], _ALNUM[data]
        letter = upper | lower
        # the word without marks at its edges
        place = np.arange(len(data))
        after = np.minimum.accumulate(np.where(alnum, place, len(data))[::-1])[::-1]
        before = np.maximum.accumulate(np.where(alnum, place, -1))
        lo = np.minimum(after[start], end)
        hi = np.maximum(np.minimum(before[end - 1] + 1, end), lo)
        letters, inner = count(letter), count(letter, lo, hi)
        plain = (count(data >= 128) == 0) & ((inner == hi - lo) | (inner == 0))
        out, number = np.zeros((len(at), 9)), np.zeros(len(at), np.uint64)
        capitals = count(upper)
        out[:, 4], out[:, 5] = letters, capitals
        out[:, 6] = (capitals > 0) & (count(lower) == 0) & (end - start > 1)
        out[:, 7], out[:, 8] = count(data == 33), count(_MARKS[data])
        folded = fold_ascii(data)
        own = np.flatnonzero(plain & (hi > lo))
        number[own] = hash_ranges(folded, lo[own], hi[own])
        out[own, 0], out[own, 2] = self._whole.of(number[own]), self._second.of(number[own])
        for n, stems in zip(STEMS, self._stems):
            long = own[hi[own] - lo[own] > n]
            out[long, 1] = np.maximum(out[long, 1], stems.of(hash_ranges(folded, lo[long], lo[long] + n)))
        if len(self._known) > self.MAX_WORDS:
            self._known.clear()
        raw, known, spelled = data.tobytes(), self._known, {}
        rest = np.flatnonzero(~plain)
        for k, h, s, e in zip(rest.tolist(), hashes[rest].tolist(), start[rest].tolist(), end[rest].tolist()):
            row = known.get(h)
            if row is None:
                row = known[h] = self._word(raw[s:e].decode())
            out[k, :7] = row[0]
            if row[1]:
                spelled[k] = row[1]
        if spelled:
            number[list(spelled)] = _hashes(list(spelled.values()))
        return out, number

    def read(self, texts: pa.Array) -> np.ndarray:
        """A row of features per text; null counts as empty."""
        words = batch_words(texts)
        n, total = words.counts(), int(words.first[-1])
        out = np.zeros((len(n), len(FEATURES)))
        if not total:
            return out
        _, at, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        order = np.argsort(at)
        rank = np.empty(len(at), np.int64)
        rank[order] = np.arange(len(at))
        rows, numbers = self._distinct(words, at[order], words.hashes[at[order]])
        of_word = rank[inverse]
        whole, stem, you, hidden, letters, capitals, upper, loud, marks = rows[of_word].T
        doc = np.repeat(np.arange(len(n)), n)
        first, some = words.first, n > 0

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.bincount(doc, weights=values, minlength=len(n))

        weight = np.maximum(whole, stem)
        hit = weight > 0
        spot = np.flatnonzero(hit)
        near = np.zeros(total + 1, np.int64)
        p = np.flatnonzero(you)
        np.add.at(near, np.maximum(first[doc[p]], p - NEAR_WORDS), 1)
        np.add.at(near, np.minimum(first[doc[p] + 1], p + NEAR_WORDS + 1), -1)
        near = np.cumsum(near)[:-1] > 0
        hits = per_text(hit)
        kinds, kind = np.unique(numbers[of_word[spot]], return_inverse=True)
        different = np.unique(doc[spot] * (len(kinds) + 1) + kind) // (len(kinds) + 1)
        close = (np.diff(spot) <= NEAR_WORDS) & (np.diff(doc[spot]) == 0)
        most = np.zeros(len(n))
        most[some] = np.maximum.reduceat(weight, first[:-1][some])
        sums = {
            "hit_density": hit, "strong_density": weight > self._strong, "stem_density": stem > 0, "weight_mean": weight,
            "near_second_person": hit & near, "second_person_density": you, "capital_words": upper, "exclamations": loud,
            "punctuation": marks, "obfuscated": hidden, "obfuscated_hits": hidden * hit}
        size = np.maximum(n, 1)
        whole_text = {
            "log_words": np.log1p(n), "hits": np.log1p(hits), "weight_max": most,
            "distinct_hits": np.log1p(np.bincount(different, minlength=len(n))),
            "capital_letters": per_text(capitals) / np.maximum(per_text(letters), 1),
            "neighbour_hits": np.bincount(doc[spot[1:]], weights=close, minlength=len(n)) / size}
        for i, name in enumerate(FEATURES):
            out[:, i] = whole_text[name] if name in whole_text else per_text(sums[name]) / size
        out[~some] = 0
        return out


def text_features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """The whole input row as ``_row`` and the ``features`` of its text (null: empty)."""
    wrapped = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    schema = f"_row {wrapped.schema['_row'].dataType.simpleString()}, features array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = FeatureReader(lexicon)
        for b in batches:
            texts = pa.RecordBatch.from_arrays([b.column(0).field("text").cast(pa.string())], names=["text"])
            rows = [reader.read(part.column(0)) for part in slices(iter([texts]))]
            flat = np.concatenate(rows).ravel() if rows else np.zeros(0)
            ends = np.arange(0, len(flat) + 1, len(FEATURES), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, flat)],
                                             names=["_row", "features"])
        del reader
        release_memory()

    return wrapped.mapInArrow(run, schema)


class ToxicityModel:
    """A fitted scorer: lexicon, trees and calibration, or a constant."""

    def __init__(self, lexicon=None, trees=None, steps=None, constant: float = 0.0):
        self.lexicon, self.trees, self.steps, self.constant = lexicon, trees, steps, constant

    def margins(self, features: DataFrame) -> DataFrame:
        """``features`` as an array column replaced by the trees' ``margin``."""
        rest = [c for c in features.columns if c != "features"]
        rows = features.withColumn("features", array_to_vector("features"))
        return self.trees.transform(rows).select(*rest, vector_to_array("rawPrediction")[1].alias("margin"))

    def scored(self, docs: DataFrame) -> DataFrame:
        """``(_row, score)`` of every row of ``docs``."""
        if self.trees is None:
            return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                               F.lit(float(self.constant)).alias("score"))
        rows = self.steps.transform(self.margins(text_features(docs, self.lexicon)))
        return rows.select("_row", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 60_000, trees: int = 40,
        depth: int = 4, seed: int = 11) -> ToxicityModel:
    """Learn from the rows whose ``crc32(doc_id as text) mod 5`` is not 0, at most
    about ``max_labelled`` of them: folds 1 to 3 fit the trees, fold 4 the
    calibration. Inputs are the text's features only. Without labels of both
    classes the score is the share of toxic labels (0 if there are none)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = labelled(base, labels, max_labelled)
    # at most max_labelled ids and labels: a bounded table
    train = persist_table(base.join(F.broadcast(known), "doc_id"), "labelled")
    counts = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return ToxicityModel(constant=counts.get(1, 0) / total if total else 0.0)
    lexicon = learn_lexicon(train)
    rows = persist_table(text_features(train, lexicon).select(
        "_row.doc_id", F.col("_row.toxic").cast("double").alias("label"), "features"), "training")
    calibration = fold_of(F.col("doc_id")) == 4
    learn, check = rows.where(~calibration), rows.where(calibration)
    if learn.select("label").distinct().count() < 2 or check.isEmpty():
        learn = check = rows
    model = ToxicityModel(lexicon, GBTClassifier(
        maxIter=trees, maxDepth=depth, stepSize=0.2, subsamplingRate=0.8, seed=seed,
        checkpointInterval=-1).fit(learn.withColumn("features", array_to_vector("features"))))
    model.steps = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(
        model.margins(check).withColumn("margin", F.round("margin", 4)))
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row; see
    :func:`fit` for the parameters.

    Null text counts as empty; rows without ``doc_id`` and repeated rows are
    scored like any other; other columns are ignored; an empty table gives an
    empty result.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return fit(base, labels, **parameters).scored(base).select(
        "_row.doc_id", F.coalesce(fold_of(F.col("_row.doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, with a score under one half."""
    return fit(docs, labels, **parameters).scored(docs).where("score < 0.5").select("_row.*")
