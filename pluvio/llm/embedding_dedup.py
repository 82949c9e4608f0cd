"""Near-duplicate vectors by sorted projection passes.

1. Equal vectors of a label form a class (one grouped aggregate), so copies are
   one row from here on.
2. Each pass orders the classes of a label lexicographically by concatenated
   random hashes (signs of random projections), and compares every vector with
   its neighbours in a bounded window of that order. Passes use other hashes.
   How many leading bits bring a vector's pairs into its window is read off the
   sorted keys, so every vector knows the probability that its pairs at the
   threshold were missed so far. Vectors above a set small probability go into
   the next round of passes; the few that stay, and labels that fit one block
   from the start, become a loose group as a whole.
3. Neighbours somewhat below the threshold already tie vectors into loose
   groups; ties of all passes are united.
4. Inside a loose group every pair is decided in double precision, block by
   block, so dense clusters wider than the window lose no link. Only counts and
   spanning links leave a block comparison.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.components import connected_components, spanning
from pluvio.session import persist_table

BITS = 62
WINDOW = 32
MISS = 1e-5
ROUNDS = 16
BLOCK_VECTORS = 1024
#: Loose ties reach this much wider than the threshold's angle.
WIDER = 1.6


def pass_count(largest: int, cosine: float, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes of one round: enough for a pair at ``cosine`` if every bit halved the
    label, so that the leading log2(n / window) bits had to agree, each with
    probability 1 - angle / pi. Whether they were enough is measured."""
    bits = max(1.0, math.log2(max(largest, 1) / window))
    hit = (1 - math.acos(cosine) / math.pi) ** bits
    return max(4, math.ceil(math.log(miss) / math.log(1 - hit)))


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """List column of equally long vectors as unit rows."""
    flat = np.asarray(column.values.slice(column.offsets[0].as_py(),
                                          column.offsets[-1].as_py() - column.offsets[0].as_py()))
    x = flat.astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(dtype)


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(values)]))


def can_link():
    """Whether a row can have links: id and label present, a finite non-zero vector."""
    e = F.col("embedding")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ok = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull()
          & ~F.exists(e, bad) & F.exists(e, lambda x: x != 0))
    return F.coalesce(ok, F.lit(False))


def _planes(seed: int, dim: int, turn: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, turn]).standard_normal((dim, BITS)).astype(np.float32)


def _pass_rows(classes: DataFrame, turns: range, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, list[np.ndarray]] = {}
        weight = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for whole in batches:
            dims = np.asarray(whole.column("dim"))
            for d in np.unique(dims):
                rows = whole.filter(pa.array(dims == d))
                for at in range(0, rows.num_rows, 2048):
                    b = rows.slice(at, 2048)
                    x = _matrix(b.column("embedding"), np.float32)
                    if d not in planes:
                        planes[d] = [_planes(seed, int(d), t) for t in turns]
                    unit = [row.tobytes() for row in x]
                    for t, plane in zip(turns, planes[d]):
                        key = ((x @ plane) > 0) @ weight
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(x), t, np.int32)), b.column("grp"), pa.array(key),
                             b.column("cid"), pa.array(unit, pa.binary())],
                            names=["turn", "grp", "key", "cid", "unit"])

    return classes.select("cid", "grp", F.size("embedding").alias("dim"), "embedding").mapInArrow(
        run, "turn int, grp long, key long, cid long, unit binary")


def _shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of leading bits that two columns of keys share."""
    x = a ^ b
    high = x >> 31  # halves, as a double does not hold 62 bits
    return BITS - np.where(high > 0, 31 + np.frexp(high)[1], np.frexp(x & (2**31 - 1))[1])


def _needed_bits(key: np.ndarray, old: int, window: int, starts: bool, ends: bool) -> np.ndarray:
    """Leading bits after which a row's bucket lies inside its window, for the rows
    from ``old`` on. Where the rows may go on outside (not ``starts``, not
    ``ends``), all that is outside counts as out of the window."""
    at = np.arange(old, len(key))
    left = _shared_bits(key[at], key[np.maximum(at - window - 1, 0)])
    right = _shared_bits(key[at], key[np.minimum(at + window + 1, len(key) - 1)])
    if starts:
        left[at <= window] = -1
    if ends:
        right[at + window >= len(key) - 1] = -1
    return np.maximum(left, right) + 1


_GRID = np.linspace(0, 8, 4097)
_LOG_PHI = np.log([0.5 + 0.5 * math.erf(v / math.sqrt(2)) for v in _GRID])


def _log_miss(x: np.ndarray, plane: np.ndarray, bits: np.ndarray, cosine: float) -> np.ndarray:
    """Logarithm of the probability that a vector at ``cosine`` to a row of ``x``
    differs from it in the leading ``bits``: a plane at distance z keeps the two
    on one side with the normal probability of |z| / tan(angle)."""
    ratio = cosine / max(1e-9, math.sqrt(1 - cosine * cosine))
    sides = np.interp(np.abs(x @ plane) * ratio, _GRID, _LOG_PHI)
    agree = np.concatenate([np.zeros((len(x), 1)), np.cumsum(sides, axis=1)], axis=1)
    hit = np.exp(agree[np.arange(len(x)), np.minimum(bits, BITS)])
    return np.log1p(-np.minimum(np.where(bits > BITS, 0.0, hit), 1 - 1e-12))


def _window_ties(rows: DataFrame, cosine: float, window: int, seed: int) -> DataFrame:
    """Spanning ties ``(a, b)`` of the neighbours that are near in one order, and
    for every row ``(a, null, log_miss)``."""
    least = math.cos(min(math.pi / 2, WIDER * math.acos(cosine)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail_ids, tail_x, tail_key, tail_at = np.zeros(0, np.int64), None, None, None
        planes: dict[tuple[int, int], np.ndarray] = {}
        first = True
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                b = whole.slice(start, 2048)
                turn, grp, keys = (np.asarray(b.column(c)) for c in ("turn", "grp", "key"))
                ids, unit = np.asarray(b.column("cid")), b.column("unit").to_pylist()
                cut = np.flatnonzero((turn[1:] != turn[:-1]) | (grp[1:] != grp[:-1])) + 1
                for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(turn)]):
                    x = np.frombuffer(b"".join(unit[lo:hi]), np.float32).reshape(hi - lo, -1)
                    name, key = ids[lo:hi], keys[lo:hi]
                    old = 0
                    if tail_at == (turn[lo], grp[lo]):
                        old = len(tail_ids)
                        x, name, key = (np.concatenate(p) for p in ((tail_x, x), (tail_ids, name), (tail_key, key)))
                    found = []
                    for o in range(1, min(window, len(x) - 1) + 1):
                        near = np.einsum("ij,ij->i", x[o:], x[:-o]) >= least
                        j = np.flatnonzero(near) + o
                        j = j[j >= old]
                        found.append(np.stack([name[j - o], name[j]], axis=1))
                    found = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
                    a, c = spanning(found) if len(found) else (found[:, 0], found[:, 1])
                    # the order may go on in the task before or after, and in the next rows
                    bits = _needed_bits(key, old, window, starts=old == 0 and not first, ends=hi < len(turn))
                    at = (x.shape[1], int(turn[lo]))
                    if at not in planes:
                        planes = {at: _planes(seed, *at)}
                    miss = _log_miss(x[old:], planes[at], bits, cosine)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([a, name[old:]])),
                         pa.concat_arrays([pa.array(c, pa.int64()), pa.nulls(len(miss), pa.int64())]),
                         pa.concat_arrays([pa.nulls(len(a), pa.float64()), pa.array(miss)])],
                        names=["a", "b", "log_miss"])
                    first = False
                    tail_at, tail_ids, tail_x, tail_key = (
                        (turn[lo], grp[lo]), name[-window:], x[-window:], key[-window:])

    return rows.mapInArrow(run, "a long, b long, log_miss double")


def _loose_ties(grouped: DataFrame, cosine: float, window: int, block_vectors: int, seed: int) -> DataFrame:
    """Ties ``(a, b)`` that unite all linked classes of ``grouped(cid, grp,
    embedding)``, but for pairs whose probability to be missed is under ``MISS``."""
    n = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = grouped.select("cid", "grp", F.lit(0.0).alias("log_miss"))
    ties, turn = [], 0
    for done in range(ROUNDS + 1):
        # at the rate so far; a dense cluster of links stays in every order
        in_time = F.col("log_miss") * (ROUNDS / max(done, 1)) <= math.log(MISS)
        sizes = persist_table(left.groupBy("grp").agg(F.count("*").alias("n"), F.min("cid").alias("a"),
                                                      F.count_if(in_time).alias("in_time")), "sizes")
        whole = F.lit(done == ROUNDS) | (F.col("n") <= block_vectors)
        if done:
            whole |= 2 * F.col("in_time") <= F.col("n")
        ties.append(left.join(sizes.where(whole), "grp").where("cid > a").select("a", F.col("cid").alias("b")))
        largest = sizes.where(~whole).agg(F.max("n")).first()[0]
        if largest is None:
            break
        left = left.join(sizes.where(~whole).select("grp"), "grp")
        turns = range(turn, turn + pass_count(largest, cosine, window))
        turn = turns.stop
        order = ["turn", "grp", "key", "cid"]
        rows = (_pass_rows(grouped.join(left.select("cid"), "cid"), turns, seed)
                .repartitionByRange(n, *order).sortWithinPartitions(*order))
        found = persist_table(_window_ties(rows, cosine, window, seed), "ties")
        ties.append(found.where("b is not null").select("a", "b"))
        more = found.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("log_miss").alias("more"))
        left = persist_table(
            left.join(more, "cid").select("cid", "grp", (F.col("log_miss") + F.col("more")).alias("log_miss"))
            .where(F.col("log_miss") > math.log(MISS)), "left")
    return functools.reduce(DataFrame.union, ties)


def _block_links(rows: DataFrame, cosine: float) -> DataFrame:
    """``(cid, links, root)`` of each comparison of a block with itself or with
    another: vectors linked there (with copies) and the smallest class of the
    component they form there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def compare():
            side, cid, copies, x = zip(*held)
            side, cid, copies = np.array(side), np.array(cid), np.array(copies)
            x = np.stack(x)
            near = x @ x.T >= cosine
            near &= (side[:, None] != side[None, :]) | (at[1] == at[2])
            np.fill_diagonal(near, False)
            links = near @ copies
            i, j = np.nonzero(np.triu(near))
            root = cid.copy()
            if len(i):
                a, b = spanning(np.stack([cid[i], cid[j]], axis=1))
                order = np.argsort(b)
                k = np.minimum(np.searchsorted(b[order], cid), len(b) - 1)
                root = np.where(b[order][k] == cid, a[order][k], cid)
            some = links > 0
            return pa.RecordBatch.from_arrays(
                [pa.array(cid[some]), pa.array(links[some], pa.int64()), pa.array(root[some])],
                names=["cid", "links", "root"])

        for b in batches:
            if b.num_rows == 0:
                continue
            dims = np.diff(np.asarray(b.column("embedding").offsets))
            for lo, hi in _runs(dims.astype(np.int64)):
                part = b.slice(lo, hi - lo)
                x = _matrix(part.column("embedding"), np.float64)
                for k, (g, i, j, s, c, n) in enumerate(zip(*(part.column(c).to_pylist() for c in (
                        "task", "lo", "hi", "side", "cid", "copies")))):
                    if (g, i, j) != at:
                        if held:
                            yield compare()
                        held, at = [], (g, i, j)
                    held.append((s, c, n, x[k]))
        if held:
            yield compare()

    return (rows.repartition("task", "lo", "hi").sortWithinPartitions("task", "lo", "hi")
            .mapInArrow(run, "cid long, links long, root long"))


def vector_links(vectors: DataFrame, cosine: float = 0.98, window: int = WINDOW,
                 block_vectors: int = BLOCK_VECTORS, seed: int = 7) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Vectors are linked if their labels are equal and not null, their lengths are
    equal and their cosine in double precision is at least ``cosine``.
    ``n_links`` counts the other rows linked directly, copies included.
    ``component_id`` is the smallest ``vec_id`` reachable. Vectors that are null,
    zero, or hold null or non-finite components, and rows without ``vec_id`` or
    label, link with nothing and are kept. Other columns are ignored; an empty
    table gives an empty result.
    """
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    classes = (base.where(can_link()).groupBy("label", "embedding")
               .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    classes = persist_table(classes.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    groups = persist_table(classes.groupBy("label", F.size("embedding").alias("dim"))
                           .agg(F.count("*").alias("n"))
                           .withColumn("grp", F.monotonically_increasing_id()), "labels")
    grouped = (classes.withColumn("dim", F.size("embedding"))
               .join(groups.select("label", "dim", "grp"), ["label", "dim"]))
    loose = connected_components(_loose_ties(grouped, cosine, window, block_vectors, seed))
    loose = persist_table(loose.withColumnRenamed("node", "cid"), "loose")
    sizes = loose.groupBy("component").agg(F.count("*").alias("size"))
    members = (classes.join(loose.join(sizes, "component"), "cid")
               .withColumn("blocks", F.ceil(F.col("size") / F.lit(block_vectors)).cast("int"))
               .withColumn("side", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")))
    meets = members.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = meets.select(F.col("component").alias("task"), F.least("side", "x").alias("lo"),
                         F.greatest("side", "x").alias("hi"), "side", "cid", "copies", "embedding")
    found = persist_table(_block_links(tasks, cosine), "links")
    direct = found.groupBy("cid").agg(F.sum("links").alias("links"))
    united = connected_components(found.select(F.col("root").alias("a"), F.col("cid").alias("b")))
    united = united.withColumnRenamed("node", "cid")
    least_rep = (classes.select("cid", "rep").join(united, "cid")
                 .groupBy("component").agg(F.min("rep").alias("least")))
    named = (classes.join(direct, "cid", "left").join(united.join(least_rep, "component"), "cid", "left")
             .select("label", "embedding",
                     (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("least", "rep").alias("component_id")))
    linked = base.where(can_link()).join(named, ["label", "embedding"]).select(
        "vec_id", "n_links", "component_id")
    alone = base.where(~can_link()).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
