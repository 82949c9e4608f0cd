"""Near-duplicate documents by SuperMinHash, banding, verification, union-find.

1. One pass turns a text into its set of hashed word shingles, a 128-bit
   fingerprint of the set and a SuperMinHash signature cut into bands.
2. Documents with equal sets form a class; only classes go on, so a group of
   exact copies is one row however large it is.
3. Classes that share a band value are tied to the smallest class there (a
   star, never all pairs). Ties whose signatures are far apart are dropped; the
   rest group the classes loosely: two classes above the threshold that share a
   band are tied to the same hub, hence in the same loose group. They lose a band
   only if its hub is unlike both of them.
4. Inside a loose group the full sets decide. Groups are cut into blocks; block
   0 is compared with every block, which unites almost everything, and what is
   not in the group's largest component is then compared with all blocks. Pairs
   that are already in one component are skipped, so no pair list exists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.components import connected_components, spanning
from pluvio.llm.words import (Words, batch_words, mix64, release_memory, sequence_hash, slices,
                              window_hashes)
from pluvio.session import persist_table

BANDS, ROWS = 28, 5
BLOCK_DOCS = 512
LOOSE = 0.4
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a batch; a text with fewer
    words than ``size`` has its whole sequence as its only shingle."""
    hashes, at = window_hashes(words, size)
    cut = np.searchsorted(at, words.first)
    out = []
    for i, n in enumerate(words.counts().tolist()):
        if n >= size:
            out.append(np.unique(hashes[cut[i]:cut[i + 1]]))
        elif n:
            own = words.hashes[words.first[i]:words.first[i + 1]]
            out.append(np.array([sequence_hash(own)], dtype=np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def super_minhash(sets: list[np.ndarray], lanes: int) -> np.ndarray:
    """SuperMinHash signatures (documents x lanes, uint64).

    Every element draws a random permutation of the lanes; its j-th draw offers
    the value (j, random) to the j-th lane of the permutation, and a lane keeps
    the least. Ranks of one element are distinct, which correlates the lanes and
    lowers the variance against independent permutations. A document stops as
    soon as all of its lanes hold a value of a smaller rank than the next draw,
    which for n elements takes about lanes * ln(lanes) / n draws each. All
    documents of the batch advance together, one rank per step."""
    docs = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    least = np.full(len(sets) * lanes, np.iinfo(np.uint64).max, dtype=np.uint64)
    order = np.tile(np.arange(lanes, dtype=np.uint8), (len(element), 1))
    with np.errstate(over="ignore"):
        for j in range(lanes):
            if not len(element):
                break
            draw = mix64(element + np.uint64(j + 1) * _STEP)
            row = np.arange(len(element))
            pick = j + (((draw >> np.uint64(32)) * np.uint64(lanes - j)) >> np.uint64(32)).astype(np.int64)
            lane = order[row, pick]
            order[row, pick] = order[row, j]
            value = (np.uint64(j) << np.uint64(56)) | (mix64(draw ^ _STEP) >> np.uint64(8))
            np.minimum.at(least, docs * lanes + lane, value)
            done = least.reshape(-1, lanes).max(axis=1) < (np.uint64(j + 1) << np.uint64(56))
            if done.any():
                go = ~done[docs]
                element, docs, order = element[go], docs[go], order[go]
    return least.reshape(-1, lanes)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per document and band; equal rows give equal keys."""
    with np.errstate(over="ignore"):
        s = mix64(signatures).reshape(len(signatures), bands, rows)
        key = np.arange(bands, dtype=np.uint64) * _STEP + np.uint64(1)
        key = np.broadcast_to(key, (len(signatures), bands)).copy()
        for r in range(rows):
            key = mix64(key * _STEP + s[:, :, r])
    return key.view(np.int64)


def features(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, fp, bands, sig`` per row, in one pass, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = shingle_sets(batch_words(b.column(1), fold_case=True), shingle)
            sig = super_minhash(sets, bands * rows)
            keys = band_keys(sig, bands, rows)
            n = len(sets)
            fp = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            low = mix64(sig).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(fp, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(keys.ravel())),
                 pa.array([low[i].tobytes() for i in range(n)], pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "fp", "bands", "sig"])
        release_memory()

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_key().alias("text_key"))
    return persist_table(d.mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, fp binary, bands array<long>, sig binary"), "shingles")


def _text_key():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _near(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs ``(a, b, sa, sb)`` whose signatures agree on ``least`` of the lanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            x, y = (np.frombuffer(b"".join(c.to_pylist()), dtype="<u2").reshape(b.num_rows, -1)
                    for c in (b.column(2), b.column(3)))
            ok = pa.array((x == y).mean(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], names=["a", "b"])

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def loose_groups(classes: DataFrame, least: float = LOOSE) -> DataFrame:
    """``(node, component)`` of classes tied through band hubs."""
    band = classes.select("cid", F.explode("bands").alias("band"))
    hubs = (band.groupBy("band").agg(F.min("cid").alias("hub"), F.max("cid").alias("top"))
            .where("hub < top").select("band", "hub"))
    ties = band.join(hubs, "band").where("cid <> hub").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    sig = classes.select("cid", "sig")
    ties = (ties.join(sig.select(F.col("cid").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sig.select(F.col("cid").alias("b"), F.col("sig").alias("sb")), "b"))
    return connected_components(_near(ties, least))


def class_sets(docs: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """Full sets of the member classes (``cid, fp, rep`` and others), read again
    from the text of the representative document."""
    d = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    d = d.join(_slots(members.select(F.col("rep").alias("id"))), _slot(F.col("rep")) == F.col("_slot"), "left_semi")
    d = d.join(members, "rep")
    keep = [c for c in members.columns if c not in ("rep", "fp")]
    schema = ", ".join(f"{c} {members.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = shingle_sets(batch_words(b.column("text"), fold_case=True), shingle)
            same = [xxhash.xxh3_128_digest(s.tobytes()) == fp for s, fp in zip(sets, b.column("fp").to_pylist())]
            ok = pa.array(same, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column(c).filter(ok) for c in keep]
                + [pa.array([s.tobytes() for s, k in zip(sets, same) if k], pa.binary())],
                names=[*keep, "items"])
        release_memory()

    # repeated rows of a representative give its class more than once: same set
    return d.mapInArrow(run, schema + ", items binary")


def _unite(ids: np.ndarray, sets: list[np.ndarray], asks: np.ndarray, label: np.ndarray,
           percent: int) -> list[tuple[int, int]]:
    """Links that unite the given classes: each class flagged in ``asks`` is
    compared with all that are not yet united with it (``label`` holds what is
    united already). Exact intersection sizes by merging sorted sets."""
    root = np.unique(label, return_inverse=True)[1]
    size = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    flat = np.concatenate(sets)
    first = np.concatenate([[0], np.cumsum(size)])
    links = []
    for i in np.flatnonzero(asks):
        other = np.flatnonzero((root != root[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])))
        if not len(other):
            continue
        count = size[other]
        at = np.repeat(first[other] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        item = flat[at]
        j = np.searchsorted(sets[i], item)
        j[j == size[i]] = size[i] - 1
        hit = np.add.reduceat((sets[i][j] == item).astype(np.int64), np.cumsum(count) - count)
        near = other[100 * hit >= percent * (size[i] + count - hit)]
        for r in np.unique(root[near]):
            links.append((int(ids[i]), int(ids[near[root[near] == r][0]])))
        root[np.isin(root, root[near])] = root[i]
    return links


def _compare(rows: DataFrame, percent: int) -> DataFrame:
    """Links inside each comparison (``task`` columns ``grp, pair``); rows hold
    ``cid, label, asks, items``. A comparison is at most two blocks of classes;
    rows arrive sorted, so a task holds one comparison at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = {}, None

        def links():
            if len(held) < 2:
                return []
            ids = np.array(list(held), dtype=np.int64)
            label, asks, sets = zip(*held.values())
            return _unite(ids, list(sets), np.array(asks), np.array(label), percent)

        def out(found):
            a, b = spanning(np.array(found, dtype=np.int64))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("grp", "pair", "cid", "label", "asks", "items")]
            for grp, pair, cid, label, asks, items in zip(*cols):
                if (grp, pair) != at:
                    if found := links():
                        yield out(found)
                    held, at = {}, (grp, pair)
                asks = asks or (cid in held and held[cid][1])
                held[cid] = (label, asks, np.frombuffer(items, dtype=np.uint64))
        if found := links():
            yield out(found)
        held = {}
        release_memory()

    return (rows.repartition("grp", "pair").sortWithinPartitions("grp", "pair")
            .mapInArrow(run, "a long, b long"))


def minhash_groups(docs: DataFrame, shingle: int = 4, percent: int = 80,
                   bands: int = BANDS, rows: int = ROWS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per input row.

    Two rows are linked if ``100 * |A & B| >= percent * |A | B|`` for their sets
    of distinct ``shingle``-word shingles (A-Z lower-cased), confirmed on the
    full sets. ``component_id`` is the smallest ``doc_id`` reachable by links.
    A candidate pair at exactly 80 % shares none of the 28 bands of 5 rows with
    probability (1 - 0.8^5)^28 < 2e-5, and less above. Bands whose hub is unlike
    both add to that: a hub at 40 % shares a band with probability 0.01, so each
    such document in front of the pair takes a hundredth of its bands.

    Null and wordless texts have the empty set and link with nothing. Rows
    without ``doc_id`` link with nothing and are kept. Repeated rows are copies
    of each other. Other columns are ignored; an empty table gives an empty
    result.
    """
    return _groups(docs, shingle, percent, bands, rows, block_docs).drop("text_key")


def first_of_groups(docs: DataFrame, shingle: int = 4, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that :func:`minhash_groups`
    keeps. Of repeated rows (same id and text) one stays; rows without
    ``doc_id`` all stay."""
    g = _groups(docs, shingle, percent, bands, rows, BLOCK_DOCS).where("doc_id is not null")
    marks = persist_table(
        g.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "kept")
        .agg(F.count("*").alias("_n")).where("not kept or _n > 1"), "marks")
    mine = (F.col("doc_id").cast("long") == F.col("_id")) & (_text_key() == F.col("_key"))
    slots = _slots(marks.select(F.col("_id").alias("id")))
    # most rows are in no slot of a marked row and stay without a join
    here = _slot(F.col("doc_id").cast("long")) == F.col("_slot")
    stay = docs.join(slots, here, "left_anti")
    maybe = docs.join(slots, here, "left_semi")
    stay = stay.union(maybe.join(marks, mine, "left_anti"))
    repeated = marks.where("kept")
    if not repeated.isEmpty():
        again = maybe.withColumn("_key", _text_key()).join(
            repeated.select(F.col("_id").alias("doc_id"), "_key"), ["doc_id", "_key"])
        stay = stay.unionByName(again.dropDuplicates(["doc_id", "_key"]).drop("_key"))
    return stay


SLOTS = 1 << 20


def _slot(doc_id):
    return F.pmod(F.xxhash64(doc_id), F.lit(SLOTS))


def _slots(ids: DataFrame) -> DataFrame:
    """Hash slots of the ids, for a broadcast: at most ``SLOTS`` numbers, however
    many ids there are. Rows in none of them need not be shuffled to a join; if
    nearly all slots are taken, the join is as large as without."""
    return F.broadcast(ids.select(_slot(F.col("id")).alias("_slot")).distinct())


def _groups(docs: DataFrame, shingle: int, percent: int, bands: int, rows: int, block_docs: int) -> DataFrame:
    if bands * rows > 255:
        raise ValueError("at most 255 lanes")
    feat = features(docs, shingle, bands, rows)
    linkable = feat.where("fp is not null and doc_id is not null")
    classes = persist_table(
        linkable.groupBy("fp").agg(F.min(F.struct("doc_id", "bands", "sig")).alias("m"))
        .select(F.monotonically_increasing_id().alias("cid"), "fp", F.col("m.doc_id").alias("rep"),
                F.col("m.bands").alias("bands"), F.col("m.sig").alias("sig")), "classes")
    loose = persist_table(loose_groups(classes), "loose")
    sizes = loose.groupBy("component").agg(F.count("*").alias("size"))
    members = persist_table(
        classes.select("cid", "fp", "rep").join(loose.withColumnRenamed("node", "cid"), "cid")
        .join(sizes, "component")
        .select("cid", "fp", "rep", F.col("component").alias("grp"),
                F.ceil(F.col("size") / F.lit(block_docs)).cast("int").alias("blocks")), "members")
    sets = class_sets(docs, members, shingle).withColumn(
        "block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # the first block meets every block
    sets = persist_table(sets, "sets")
    pairs = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = persist_table(_compare(sets.select(
        "grp", F.explode(pairs).alias("pair"), "cid", F.col("cid").alias("label"), F.lit(True).alias("asks"),
        "items"), percent), "links")
    links = first
    wide = sets.where("blocks > 1")
    if not wide.isEmpty():
        # what is outside a group's largest component meets all its blocks
        so_far = connected_components(first)
        wide = wide.join(so_far, wide["cid"] == so_far["node"], "left").select(
            "grp", "cid", F.coalesce("component", "cid").alias("label"), "blocks", "block", "items")
        weight = wide.groupBy("grp", "label").agg(F.count("*").alias("n"))
        main = weight.groupBy("grp").agg(F.max(F.struct("n", "label")).alias("m")).select("grp", F.col("m.label").alias("main"))
        wide = persist_table(wide.join(main, "grp").withColumn("outside", F.col("label") != F.col("main")), "wide")
        ask = wide.where("outside").select(
            "grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to"), F.col("block").alias("by"),
            "cid", "label", F.lit(True).alias("asks"), "items")
        by = wide.where("outside").select("grp", F.col("block").alias("by")).distinct()
        told = wide.join(by, "grp").select("grp", F.col("block").alias("to"), "by", "cid", "label",
                                           F.lit(False).alias("asks"), "items")
        rest = ask.union(told).select("grp", (F.col("by").cast("long") * (1 << 31) + F.col("to")).alias("pair"),
                                      "cid", "label", "asks", "items")
        links = links.union(_compare(rest, percent))
    found = connected_components(links)
    least = (classes.select("cid", "rep").join(found.withColumnRenamed("node", "cid"), "cid")
             .groupBy("component").agg(F.min("rep").alias("least")))
    least = found.join(least, "component").select(F.col("node").alias("cid"), "least")
    named = (classes.select("cid", "fp", "rep").join(least, "cid", "left")
             .select("fp", F.coalesce("least", "rep").alias("component_id")))
    return (feat.select("doc_id", "text_key", "n_shingles", "fp").join(named, "fp", "left")
            .select("doc_id", "text_key", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
