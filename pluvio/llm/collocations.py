"""Phrase collocations by vertically partitioned, depth-truncated suffix subtrees.

Texts become blocks of word numbers once. Every word position starts a suffix, cut at
the end of its piece and after four words. The suffixes are partitioned by their first
words: prefixes are taken in key order into groups that hold about one memory budget,
and a prefix beyond the budget is extended to its whole suffixes, which are dealt over
groups of their own. Each group's subtree is built independently: it is the group's
sorted leaves, the distinct suffixes with their occurrences, and the count of a phrase
is the sum of the leaf totals below it.

The depth grows elastically: subtrees of depth two come first, and only suffixes that
go on through frequent pairs are read again to depth four. Which words and pairs are
frequent reaches the tasks as a bit table of bounded size; a pair that it lets through
in error costs a suffix more and changes no count.

Words are told apart by 64-bit hashes of language and word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.blocks import pack_array, unpack_array
from pluvio.llm.words import fold_ascii, hash_ranges, mix64, release_memory, slices, text_buffers, word_spans
from pluvio.operators.ordered import sums_before
from pluvio.session import persist_table

DEPTH = 4
#: Suffixes of one group, whose subtree a task holds in memory.
BUDGET = 1_500_000
#: Words of one language in a block, before it is written.
BLOCK_WORDS = 2_000_000

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, size=DEPTH, dtype=np.uint64) | np.uint64(1)

ENCODED = "lang string, n long, keys binary, counts binary, words binary, ids binary"


def _pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, word starts and ends, words before each document's first, and
    whether a word begins a piece."""
    data, off = text_buffers(texts)
    data = fold_ascii(data)
    breaks = _BREAK[data]
    start, end, first = word_spans(np.where(breaks, np.uint8(32), data), off)
    before = np.concatenate([[0], np.cumsum(breaks, dtype=np.int64)])[start]
    begins = np.ones(len(start), bool)
    begins[1:] = before[1:] != before[:-1]
    begins[first[:-1][first[:-1] < len(start)]] = True
    return data, start, end, first, begins


class _Block:
    """Words of one language on their way into a block."""

    def __init__(self):
        self.hashes: list[np.ndarray] = []
        self.begins: list[np.ndarray] = []
        self.texts: dict[int, bytes] = {}
        self.n = 0

    def add(self, data, start, end, hashes, begins):
        self.hashes.append(hashes)
        self.begins.append(begins)
        self.n += len(hashes)
        keys, at = np.unique(hashes, return_index=True)
        raw = data.tobytes()
        for k, s, e in zip(keys.tolist(), start[at].tolist(), end[at].tolist()):
            if k not in self.texts:
                self.texts[k] = raw[s:e]

    def row(self, lang: str) -> tuple:
        salt = hash_ranges(np.frombuffer(lang.encode() or b"\x00", np.uint8), np.array([0]),
                           np.array([max(1, len(lang.encode()))]))[0]
        hashes, begins = np.concatenate(self.hashes), np.concatenate(self.begins)
        plain, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        with np.errstate(over="ignore"):
            keys = mix64(plain ^ (salt * _STEP))
        words = [self.texts[k] for k in plain.tolist()]
        # word numbers from 1; a piece's first word is marked by a 0 before it
        ids = np.zeros(len(hashes) + int(begins.sum()), np.uint32)
        ids[np.arange(len(hashes)) + np.cumsum(begins)] = inverse.astype(np.uint32) + 1
        words = pa.array(words, pa.binary())
        return (lang, len(hashes), pack_array(keys), pack_array(counts.astype(np.uint32)),
                _ipc(words), pack_array(ids))


def _ipc(column: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([column], names=["w"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _words_of(blob: bytes) -> pa.Array:
    with pa.ipc.open_stream(blob) as r:
        return r.read_next_batch().column(0)


def encoded_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Blocks of word numbers, one language each, written to the shared folder."""
    names = ["lang", "n", "keys", "counts", "words", "ids"]
    types = [pa.string(), pa.int64()] + [pa.binary()] * 4

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Block] = {}

        def flush(lang):
            row = held.pop(lang).row(lang)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for b in slices(batches):
            data, start, end, first, begins = _pieces(b.column(0))
            hashes = hash_ranges(data, start, end)
            lang = b.column(1).dictionary_encode()
            of_doc = np.asarray(lang.indices)
            of_word = np.repeat(of_doc, np.diff(first))
            for i, name in enumerate(lang.dictionary.to_pylist()):
                own = np.flatnonzero(of_word == i)
                if len(own):
                    held.setdefault(name, _Block()).add(data, start[own], end[own], hashes[own], begins[own])
            # the fullest languages go first: what is held stays within two blocks
            while held and (sum(h.n for h in held.values()) > block_words):
                yield flush(max(held, key=lambda k: held[k].n))
        for name in list(held):
            yield flush(name)
        release_memory()

    rows = docs.select(F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return persist_table(rows.mapInArrow(build, ENCODED), "encoded")


def _local_words(blocks: DataFrame) -> DataFrame:
    """``(lang, key, word, n)``: the distinct words of each block."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                keys = unpack_array(row["keys"]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * len(keys), pa.string()),
                     pa.array(keys), _words_of(row["words"]).cast(pa.string()),
                     pa.array(unpack_array(row["counts"]).astype(np.int64))],
                    names=["lang", "key", "word", "n"])

    return blocks.select("lang", "keys", "counts", "words").mapInArrow(
        run, "lang string, key long, word string, n long")


class BitTable:
    """A set of 64-bit keys by their first bits: no member is missed, others may pass.
    At most 2^MAX_BITS bits, whatever the number of keys."""

    MAX_BITS = 27

    def __init__(self, octets: np.ndarray, bits: int):
        self._octets, self._shift = octets, np.uint64(64 - bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> self._shift
        return self._octets[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 > 0

    @classmethod
    def of(cls, keys: DataFrame, column: str) -> "BitTable":
        """At most 2^MAX_BITS / 32768 rows of 4 KB reach the driver."""
        bits = min(cls.MAX_BITS, max(16, (16 * keys.count()).bit_length()))
        slot = F.shiftrightunsigned(column, 64 - bits) + 1
        rows = keys.groupBy(F.bitmap_bucket_number(slot).alias("at")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
        octets = np.zeros(1 << (bits - 3), np.uint8)
        for r in rows:
            octets[(r["at"] - 1) * 4096:r["at"] * 4096] = np.frombuffer(r["bits"], np.uint8)
        return cls(octets, bits)


def prefix_key(columns: list[np.ndarray]) -> np.ndarray:
    """64-bit key of a prefix of word keys; that of one word is its own key."""
    out = columns[0]
    with np.errstate(over="ignore"):
        for d, c in enumerate(columns[1:], start=1):
            out = mix64(out * _STEP + c * _SEEDS[d])
    return out


class Suffixes:
    """Distinct truncated suffixes of a block: word numbers by depth (0: none), sorted,
    and their occurrences."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, words: BitTable, pairs: BitTable | None):
        """``ids``: word numbers, 0 at breaks; ``keys``: word keys by number. Without
        ``pairs`` suffixes have two words, else three or four joined by frequent pairs."""
        known = words.has(keys)
        known[0] = False
        live = np.concatenate([np.where(known[ids], ids, np.uint32(0)), np.zeros(DEPTH, np.uint32)])
        link = (live[:-1] > 0) & (live[1:] > 0)
        if pairs is not None:
            at = np.flatnonzero(link)
            link[at] = pairs.has(prefix_key([keys[live[at]], keys[live[at + 1]]]))
        n = len(ids)
        if pairs is None:
            at = np.flatnonzero(link[:n])
            high = live[at].astype(np.uint64) << np.uint64(32) | live[at + 1]
            high, self.count = np.unique(high, return_counts=True)
            low = np.zeros(len(high), np.uint64)
        else:
            at = np.flatnonzero(link[:n] & link[1:n + 1])
            high = live[at].astype(np.uint64) << np.uint64(32) | live[at + 1]
            low = live[at + 2].astype(np.uint64) << np.uint64(32) | np.where(link[at + 2], live[at + 3], 0)
            order = np.lexsort((low, high))
            high, low = high[order], low[order]
            new = np.ones(len(high), bool)
            new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
            cut = np.flatnonzero(new)
            self.count = np.diff(np.append(cut, len(high)))
            high, low = high[cut], low[cut]
        self.ids = [(x >> np.uint64(s)).astype(np.uint32) for x, s in ((high, 32), (high, 0), (low, 32), (low, 0))]


class Partition:
    """Groups of prefixes: ``cuts`` are the first keys of the groups of prefixes that fit
    the budget, in key order; suffixes of the ``over`` prefixes go by their whole key to
    ``extra`` groups."""

    def __init__(self, depth: int, whole: int, cuts: np.ndarray, over: np.ndarray, extra: int):
        self.depth, self.whole, self.cuts, self.over, self.extra = depth, whole, cuts, over, extra
        self.n_groups = len(cuts) + extra

    def groups(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Group of each suffix, and the depth of its prefix."""
        key = prefix_key(columns[:self.depth])
        group = np.maximum(np.searchsorted(self.cuts, key, side="right") - 1, 0)
        wide = np.isin(key, self.over)
        if wide.any():
            whole = mix64(prefix_key([c[wide] for c in columns]))
            group[wide] = len(self.cuts) + (whole % np.uint64(self.extra)).astype(np.int64)
        return group, np.where(wide, self.whole, self.depth).astype(np.uint8)


#: Most groups a partition makes before its budget grows.
MAX_GROUPS = 1 << 18


def vertical_partition(prefixes: DataFrame, depth: int, whole: int, budget: int) -> Partition:
    """Partition of the suffixes of up to ``whole`` words that begin with ``prefixes (key, held)``, ``held`` being
    the suffixes of each. What reaches the driver is one row per group and one per
    prefix beyond the budget, at most 2 * MAX_GROUPS in all."""
    total = prefixes.agg(F.sum("held")).first()[0] or 0
    budget = max(budget, total // MAX_GROUPS + 1)
    over = prefixes.where(F.col("held") > budget).collect()
    # keys are unsigned where they are searched
    order = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))
    fits = prefixes.where(F.col("held") <= budget).select(order.alias("key"), "held")
    sums = sums_before(fits, [], ["key"], {"before": "held"})
    firsts = sums.groupBy(F.expr(f"before div {budget}")).agg(F.min("key").alias("key")).collect()
    cuts = np.array(sorted(r["key"] + (1 << 63) for r in firsts) or [0], np.uint64)
    return Partition(depth, whole, cuts, np.array([r["key"] for r in over], np.int64).view(np.uint64),
                     -(-sum(r["held"] for r in over) // budget))


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    group, payload = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), pa.array(payload, pa.binary())],
                                      names=["group", "payload"])


def dealt(blocks: DataFrame, words: BitTable, pairs: BitTable | None, partition: Partition) -> DataFrame:
    """``(group, payload)``: each block's suffixes, packed for the groups of their prefixes."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                keys = np.concatenate([[np.uint64(0)], unpack_array(row["keys"])])
                s = Suffixes(unpack_array(row["ids"]), keys, words, pairs)
                group, split = partition.groups([keys[i] for i in s.ids])
                order = np.argsort(group, kind="stable")
                cut = np.flatnonzero(np.diff(group[order], prepend=-1))
                out, size = [], 0
                for lo, hi in zip(cut, np.append(cut[1:], len(order))):
                    own = order[lo:hi]
                    used, at = np.unique(np.concatenate([i[own] for i in s.ids]), return_inverse=True)
                    parts = [keys[used], s.count[own].astype(np.uint32), split[own],
                             *np.split(at.astype(np.uint32), DEPTH)]
                    packed = [pack_array(p) for p in parts]
                    out.append((int(group[own[0]]), np.array([len(p) for p in packed], np.int64).tobytes() + b"".join(packed)))
                    size += len(out[-1][1])
                    if size > 4 << 20:
                        yield _messages(out)
                        out, size = [], 0
                yield _messages(out)
        release_memory()

    return blocks.select("keys", "ids").mapInArrow(run, "group long, payload binary")


def _read_message(blob: bytes) -> list[np.ndarray]:
    sizes = np.frombuffer(blob[:8 * (DEPTH + 3)], np.int64)
    ends = 8 * (DEPTH + 3) + np.cumsum(sizes)
    return [unpack_array(blob[e - n:e]) for e, n in zip(ends.tolist(), sizes.tolist())]


def subtree(messages: list[bytes], least: int, depths: range) -> list[np.ndarray]:
    """Nodes of ``depths``: word keys by depth (0: none) and the sum of the leaf totals
    below. Nodes at or below their prefix are whole and given from ``least``
    occurrences; those above it have leaves in other groups too, and are all given."""
    parts = [_read_message(m) for m in messages]
    keys = np.unique(np.concatenate([p[0] for p in parts]))
    ids = [np.concatenate([np.searchsorted(keys, p[0])[p[3 + d]] for p in parts]).astype(np.uint64) for d in range(DEPTH)]
    count, split = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (1, 2))
    high, low = ids[0] << np.uint64(32) | ids[1], ids[2] << np.uint64(32) | ids[3]
    del ids
    order = np.lexsort((low, high)) if len(depths) > 1 else np.argsort(high, kind="stable")
    high, low, count, split = high[order], low[order], count[order], split[order]
    found = [[] for _ in range(DEPTH + 1)]
    for depth in depths:
        below = low >> np.uint64(32) if depth == 3 else low
        new = np.ones(len(high), bool)
        new[1:] = high[1:] != high[:-1]
        if depth > 2:
            new[1:] |= below[1:] != below[:-1]
        cut = np.flatnonzero(new)
        total = np.add.reduceat(count, cut) if len(cut) else np.zeros(0, np.int64)
        word = [keys[(x[cut] >> np.uint64(s) & np.uint64(0xFFFFFFFF)).astype(np.int64)]
                for x, s in ((high, 32), (high, 0), (low, 32), (low, 0))]
        keep = (word[depth - 1] != 0) & ((total >= least) | (split[cut] > depth))
        for d in range(DEPTH):
            found[d].append(word[d][keep] * np.uint64(d < depth))
        found[DEPTH].append(total[keep].view(np.uint64))
    return [np.concatenate(f) for f in found]


WORDS = ("w1", "w2", "w3", "w4")


def _grown(messages: DataFrame, partition: Partition, least: int, depths: range) -> DataFrame:
    """``(w1..w4, key, a)``, ``key`` being that of the first two words: the nodes of all groups' subtrees with ``least`` occurrences. A
    task holds one group at a time."""
    parallel = 4 * int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(partition.n_groups, parallel))

    def run(batches):
        held, at = [], None

        def nodes():
            *words, a = subtree(held, least, depths)
            return pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)) for f in (*words, prefix_key(words[:2]), a)],
                                              names=[*WORDS, "key", "a"])

        for b in batches:
            for group, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if group != at and held:
                    yield nodes()
                    held = []
                at = group
                held.append(payload)
        if held:
            yield nodes()
        held = []
        release_memory()

    owner = F.expr(f"cast(`group` % {tasks} as int)")
    rows = messages.withColumn("owner", owner).repartitionById(tasks, "owner").sortWithinPartitions("group")
    found = rows.select("group", "payload").mapInArrow(run, ", ".join(f"{c} long" for c in (*WORDS, "key", "a")))
    if partition.extra:  # nodes above an extended prefix come from several groups
        found = found.groupBy(*WORDS, "key").agg(F.sum("a").alias("a"))
    return persist_table(found.where(F.col("a") >= least), "phrases")


def phrase_counts(blocks: DataFrame, words: DataFrame, least: int, budget: int) -> DataFrame:
    """``(w1..w4, a)``: phrases of 2 to 4 words with at least ``least`` occurrences."""
    known = BitTable.of(words, "key")
    by_word = vertical_partition(words.select("key", F.col("f").alias("held")), 1, 2, budget)
    two = _grown(dealt(blocks, known, None, by_word), by_word, least, range(2, 3))
    pairs = BitTable.of(two, "key")
    by_pair = vertical_partition(two.select("key", F.col("a").alias("held")), 2, DEPTH, budget)
    more = _grown(dealt(blocks, known, pairs, by_pair), by_pair, least, range(3, DEPTH + 1))
    return two.unionByName(more).drop("key")


def _exact(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def _scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Each phrase with ``a`` and the ``l``, ``r``, ``score`` of its weakest cut."""
    zero = F.lit(0).cast("long")
    p = phrases.withColumn("m", F.when(F.col("w3") == 0, 2).when(F.col("w4") == 0, 3).otherwise(4))
    counts = words.select(F.col("key").alias("p1"), zero.alias("p2"), zero.alias("p3"), "f").unionByName(
        p.where("m < 4").select(F.col("w1").alias("p1"), F.col("w2").alias("p2"), F.col("w3").alias("p3"), F.col("a").alias("f")))
    first = {1: ("w1", zero, zero), 2: ("w1", "w2", zero), 3: ("w1", "w2", "w3")}
    rest = {1: ("w2", "w3", "w4"), 2: ("w3", "w4", zero), 3: ("w4", zero, zero)}

    def part(cut: int, side: str, columns) -> Column:
        return F.struct(F.lit(cut).alias("cut"), F.lit(side).alias("side"),
                        *[(F.col(c) if isinstance(c, str) else c).alias(f"p{i + 1}") for i, c in enumerate(columns)])

    needed = F.filter(F.array(*[part(k, side, c[k]) for k in first for side, c in (("l", first), ("r", rest))]),
                      lambda x: x["cut"] < F.col("m"))
    asked = p.select(*WORDS, "m", "a", F.explode(needed).alias("x")).select("*", "x.*").drop("x")
    got = asked.join(counts, ["p1", "p2", "p3"]).groupBy(*WORDS, "m", "a").agg(
        *[F.max(F.when((F.col("cut") == k) & (F.col("side") == s), F.col("f"))).alias(f"{s}{k}") for k in first for s in "lr"])

    def cut(k: int) -> Column:
        score = F.expr(f"cast((cast(2000000 as decimal(38,0)) * a) div (cast(l{k} as decimal(38,0)) + r{k}) as long)")
        return F.when(F.col("m") > k, F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
                                               F.col(f"r{k}").alias("r")))

    best = F.least(cut(1), cut(2), cut(3))
    return got.withColumn("best", best).select(*WORDS, "m", "a", "best.score", "best.l", "best.r")


def _not_inside(scored: DataFrame, percent: int = 80) -> DataFrame:
    """Phrases without those that mostly occur inside one longer candidate."""
    zero = F.lit(0).cast("long")

    def sub(*columns) -> Column:
        c = [F.col(x) for x in columns] + [zero] * (3 - len(columns))
        return F.struct(*[x.alias(f"s{i + 1}") for i, x in enumerate(c)])

    three, four = (("w1", "w2"), ("w2", "w3")), (("w1", "w2", "w3"), ("w2", "w3", "w4"), ("w1", "w2"), ("w2", "w3"), ("w3", "w4"))
    inner = F.when(F.col("m") == 3, F.array(*[sub(*c) for c in three])).otherwise(F.array(*[sub(*c) for c in four]))
    longer = scored.where("m > 2").select(F.col("a").alias("longer"), F.explode(inner).alias("s")).select("longer", "s.*")
    most = longer.groupBy("s1", "s2", "s3").agg(F.max("longer").alias("longer"))
    joined = scored.join(most, (F.col("w1") == F.col("s1")) & (F.col("w2") == F.col("s2")) & (F.col("w3") == F.col("s3"))
                         & (F.col("w4") == 0), "left")
    inside = _exact(F.lit(100)) * F.col("longer") >= _exact(F.lit(percent)) * F.col("a")
    return joined.where(~F.coalesce(inside, F.lit(False))).drop("s1", "s2", "s3", "longer")


def _named(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with language and words."""
    each = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), F.col(w).alias("key")) for i, w in enumerate(WORDS)]),
                    lambda x: x["key"] != 0)
    rows = phrases.select("*", F.explode(each).alias("x")).select("*", "x.*").drop("x")
    own = [c for c in phrases.columns]
    named = rows.join(words.select("key", "lang", "word"), "key").groupBy(*own).agg(
        F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("i", "word"))).alias("x"))
    return named.withColumn("phrase", F.concat_ws(" ", F.transform("x", lambda x: x["word"]))).drop("x")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, budget: int = BUDGET,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """The ``top`` phrases of each language: ``(lang, rank, phrase, a, l, r, n, score)``.

    A phrase has 2 to 4 words of one piece and at least ``least`` occurrences; ``score``
    is that of its weakest cut, ``floor(2000000 a / (l + r))``, ties going to the
    shortest first part. Phrases that lie in a longer one with at least 80 % of their
    occurrences are left out. Ranked by score, then ``a`` (descending), then phrase in
    UTF-8 byte order. A-Z is folded.

    Null text is empty and a null ``lang`` is ``und``; repeated rows count again; long
    texts are read whole; only ``text`` and ``lang`` are read, so other columns may have
    any name; languages without a candidate, and an empty table, give no rows."""
    blocks = encoded_blocks(docs, block_words)
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    words = persist_table(_local_words(blocks).groupBy("lang", "key", "word").agg(F.sum("n").alias("f"))
                          .where(F.col("f") >= least), "words")
    scored = persist_table(_scored(phrase_counts(blocks, words, least, budget), words), "scored")
    named = _named(_not_inside(scored), words)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each share of a language first, so that no task ranks a whole one
    shares = F.pmod(F.xxhash64("phrase"), F.lit(64))
    few = named.withColumn("share", shares).withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql() -> str:
    return r"""
    WITH d AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
    g AS (
        SELECT lang, list_aggregate(w[i:i + m - 1], 'string_agg', ' ') AS phrase, m, count(*) AS a
        FROM p, range(1, 5) AS t(m), unnest(range(1, len(w) - m + 2)) AS u(i) GROUP BY ALL HAVING count(*) >= 30),
    n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY 1),
    c AS (SELECT *, string_split(phrase, ' ') AS w FROM g WHERE m > 1),
    cut AS (
        SELECT c.lang, c.phrase, c.m, c.a, c.w, k, x.a AS l, y.a AS r,
               (2000000::HUGEINT * c.a) // (x.a + y.a) AS score
        FROM c, unnest(range(1, c.m)) AS u(k)
        JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ')
        JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
    worst AS (
        SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (
        SELECT c.lang, array_to_string(c.w[s:s + len - 1], ' ') AS phrase, max(c.a) AS longer
        FROM c, range(2, 4) AS t(len), unnest(range(1, c.m - len + 2)) AS u(s) WHERE len < c.m GROUP BY ALL),
    kept AS (
        SELECT worst.* FROM worst LEFT JOIN inside USING (lang, phrase)
        WHERE coalesce(100::HUGEINT * longer < 80::HUGEINT * a, true))
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
           score::BIGINT AS score
    FROM kept JOIN n USING (lang)
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000"""
