"""Prefix trie of conversations with subtree figures, by a depth-band rollup.

A node is a distinct sequence of first turns. Its key is the running XOR of a hash of
each turn with its depth, so keys of all prefixes come from sums inside blocks of
turns and, one level up, of blocks; a conversation of any length is never in one task.

Figures of subtrees come from a rollup in bands of fixed height: a node explodes only
to its ancestors inside its band. Band roots then hold their band's totals and form a
trie whose depths are a band height smaller, which is rolled up in the same way; their
completed totals go to the ancestors in the band above. With bands of height H and D
turns that takes log D / log H rounds and at most H rows per node and round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators.ordered import sums_before
from pluvio.session import persist_table

KEY = ("k1", "k2")
NODE = ("depth", *KEY)
BAND = 8
BLOCK = 64
#: Ids joined into one piece of text before they are hashed.
CHUNK = 4096


def first_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first one of its hundred."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("long")


def positioned_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, c1, c2, n_chars)``: turns in order, from 1. A turn's number
    orders it (null first), then its role and text; null role and text are empty; rows
    without ``conv_id`` belong to no conversation. Content is 120 bits of a SHA-256."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # equal rows are told apart by where they lie, so that many of them spread too
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    numbered = sums_before(rows, ["conv_id"], [F.asc_nulls_first("turn"), "role", "text", "at"], {"pos": F.lit(1)})
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return numbered.select("conv_id", (F.col("pos") + 1).cast("long").alias("pos"), *[
        F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("long").alias(f"c{i + 1}") for i in (0, 1)],
        F.length("text").cast("long").alias("n_chars"))


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations ``(conv_id, n_turns)`` and their turns ``(conv_id, depth, c1, c2,
    n_chars)`` after each has taken the first turns of conversation ``c - c % 100``."""
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n_own")).withColumns(
        {"base": F.col("conv_id") - F.col("conv_id") % 100, "h": first_turns(F.col("conv_id"))})
    own = persist_table(own, "conversations")
    bases = own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = persist_table(own.join(bases, "base", "left").select(
        "conv_id", "base", "h", "n_own", F.least("h", F.coalesce("n_base", F.lit(0))).cast("long").alias("taken")),
        "conversations")
    kept = turns.where(F.col("pos") > first_turns(F.col("conv_id"))).join(
        convs.select("conv_id", "h", "taken"), "conv_id")
    # a base has at most 5 turns that are taken and 199 conversations that take them
    given = turns.where("pos <= 5").select(F.col("conv_id").alias("base"), "pos", "c1", "c2", "n_chars").join(
        convs.select("conv_id", "base", "taken"), "base").where("pos <= taken")
    rows = given.select("conv_id", F.col("pos").alias("depth"), "c1", "c2", "n_chars").unionByName(
        kept.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "c1", "c2", "n_chars"))
    return (convs.select("conv_id", (F.col("taken") + F.greatest(F.lit(0), F.col("n_own") - F.col("h"))).alias("n_turns")),
            persist_table(rows, "turns"))


def running_keys(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows (conv_id, depth, t1, t2)``, depths from 1 without gaps, with the XOR of
    ``t1`` and ``t2`` up to each depth as ``k1``, ``k2``: inside blocks of turns, and
    before a block by the same function over the blocks' totals."""
    at = F.floor((F.col("depth") - 1) / block).cast("long")
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("block", at)
    keyed = rows.withColumns({k: F.bit_xor(t).over(inside) for k, t in (("k1", "t1"), ("k2", "t2"))})
    if not rows.where("block > 0").limit(1).count():
        return keyed.drop("block")
    total = persist_table(rows.groupBy("conv_id", "block").agg(F.bit_xor("t1").alias("t1"), F.bit_xor("t2").alias("t2")),
                          "blocks")
    before = running_keys(total.select("conv_id", (F.col("block") + 1).alias("depth"), "t1", "t2"), block).select(
        "conv_id", F.col("depth").alias("block"), F.col("k1").alias("b1"), F.col("k2").alias("b2"))
    out = keyed.join(before, ["conv_id", "block"], "left")
    return out.withColumns({k: F.col(k).bitwiseXOR(F.coalesce(b, F.lit(0))) for k, b in (("k1", "b1"), ("k2", "b2"))}) \
              .drop("block", "b1", "b2")


def rollup(nodes: DataFrame, paths: DataFrame, sums: Sequence[str], band: int = BAND) -> DataFrame:
    """Sum of ``sums`` over each node's subtree: ``(depth, k1, k2, *sums)``.

    ``nodes`` has (depth, k1, k2, conv_id, *sums), ``conv_id`` being any conversation
    that passes the node; ``paths`` has the nodes each conversation passes (conv_id,
    depth, k1, k2), depth 0 included."""
    own = nodes.withColumn("band", F.floor(F.col("depth") / band).cast("long"))
    # the nodes of a conversation in one band: at most ``band`` of them
    segments = paths.groupBy("conv_id", F.floor(F.col("depth") / band).cast("long").alias("band")).agg(
        F.sort_array(F.collect_list(F.struct(*NODE))).alias("path"))
    segments = persist_table(segments, "segments")

    def lifted(rows: DataFrame) -> DataFrame:
        up = rows.join(segments, ["conv_id", "band"]).select(
            F.explode(F.filter("path", lambda p: p["depth"] <= F.col("depth"))).alias("p"), *sums)
        return up.select("p.*", *sums)

    inside = persist_table(lifted(own).groupBy(*NODE).agg(*[F.sum(s).alias(s) for s in sums]), "bands")
    if not own.where("band > 0").limit(1).count():
        return inside
    roots = inside.where(F.col("depth") % band == 0).join(nodes.select(*NODE, "conv_id"), list(NODE))
    smaller = (F.col("depth") / band).cast("long").alias("depth")
    complete = rollup(roots.select(smaller, *KEY, "conv_id", *sums),
                      paths.where(F.col("depth") % band == 0).select("conv_id", smaller, *KEY), sums, band)
    # a completed root counts for the nodes above it in the band before its own
    done = complete.where("depth > 0").select((F.col("depth") * band).alias("depth"), *KEY, *sums).join(
        nodes.select(*NODE, "conv_id"), list(NODE)).withColumn("band", (F.col("depth") / band).cast("long") - 1)
    return persist_table(inside.unionByName(lifted(done)).groupBy(*NODE).agg(*[F.sum(s).alias(s) for s in sums]), "bands")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``(depth, k1, k2, conv_id)`` as comma-joined texts of at most CHUNK ids."""
    out, at, ids = [], None, []

    def flush():
        if ids:
            out.append((*at, ids[0], ",".join(map(str, ids))))

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in (*NODE, "conv_id"))):
            if row[:3] != at or len(ids) >= CHUNK:
                flush()
                at, ids = row[:3], []
            ids.append(row[3])
        if len(out) >= 256:
            yield _table(out, (*NODE, "first", "ids"), pa.string())
            out = []
    flush()
    yield _table(out, (*NODE, "first", "ids"), pa.string())


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order, to one hash per node; only the hash state is held."""
    out, at, state = [], None, None
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in (*NODE, "ids"))):
            if row[:3] != at:
                if at is not None:
                    out.append((*at, state.hexdigest()))
                at, state = row[:3], hashlib.sha256()
            else:
                state.update(b",")
            state.update(row[3].encode())
        if len(out) >= 4096:
            yield _table(out, (*NODE, "ends_sha256"), pa.string())
            out = []
    if at is not None:
        out.append((*at, state.hexdigest()))
    yield _table(out, (*NODE, "ends_sha256"), pa.string())


def _table(rows: list[tuple], names: Sequence[str], last: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, last if i == len(names) - 1 else pa.int64()) for i, c in enumerate(columns)], names=list(names))


def ends_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids of the conversations that end at each
    node. Ids of a node that very many conversations share are sorted by ranges and
    joined in chunks there; one task only streams the chunks through the hash."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*NODE, "conv_id"]
    chunks = ends.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "depth long, k1 long, k2 long, first long, ids string")
    return chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        _hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, band: int = BAND, block: int = BLOCK) -> DataFrame:
    """One row per trie node of the rebuilt conversations: ``conv_id`` (its smallest
    member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Turns are ordered by number (null first), ties by role and text; null roles and
    texts are empty; rows without ``conv_id`` are ignored; repeated rows are turns of
    their own; long texts and conversations are taken whole; other columns may have any
    name; an empty table has no conversation and no node."""
    convs, turns = rebuilt_turns(positioned_turns(conversations))
    term = {f"t{i}": F.xxhash64(F.lit(i), f"c{i}", f"c{3 - i}", "depth") for i in (1, 2)}
    steps = running_keys(turns.select("conv_id", "depth", "n_chars", *[c.alias(k) for k, c in term.items()]), block)
    parent = [F.col(f"k{i}").bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i in (1, 2)]
    zero = F.lit(0).cast("long")
    path = persist_table(
        steps.select("conv_id", *NODE, *parent, "n_chars").unionByName(convs.select(
            "conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"),
            zero.alias("n_chars"))), "paths")
    nodes = persist_table(path.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_chars").alias("n_chars"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2")), "nodes")
    up = {"depth": F.col("depth") - 1, "k1": F.col("p1"), "k2": F.col("p2")}
    children = nodes.where("depth > 0").select(*[c.alias(k) for k, c in up.items()]).groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = persist_table(nodes.join(children, list(NODE), "left").withColumn(
        "n_children", F.coalesce("n_children", zero)), "nodes")
    weights = nodes.select(*NODE, "conv_id", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                           ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"))
    totals = rollup(weights, path.select("conv_id", *NODE), ["n_leaves", "saved_tokens"], band)
    ends = ends_hashes(path.select("conv_id", *NODE).join(
        convs.select("conv_id", F.col("n_turns").alias("depth")), ["conv_id", "depth"]))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                         F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return (nodes.join(totals, list(NODE)).join(ends, list(NODE), "left")
            .join(above, ["depth", "p1", "p2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))


def oracle_sql() -> str:
    return r"""
    WITH t AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (SELECT DISTINCT conv_id FROM t),
    h AS (
        SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
            list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
            lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 6 AS h
        FROM ids),
    r AS (
        SELECT h.conv_id, role, text, pos FROM h JOIN t ON t.conv_id = h.base AND pos <= h
        UNION ALL
        SELECT h.conv_id, role, text, pos + 10 FROM h JOIN t ON t.conv_id = h.conv_id AND pos > h),
    n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth FROM r),
    p AS (
        SELECT conv_id, depth, length(text) AS chars, list({'r': role, 't': text}) OVER (
            PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS key FROM n
        UNION ALL SELECT conv_id, 0, 0, [] FROM ids),
    last AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY 1),
    node AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM p GROUP BY 1, 2),
    child AS (SELECT key[:depth - 1] AS key, count(*) AS n_children, min(depth) AS d FROM node WHERE depth > 0 GROUP BY 1),
    own AS (
        SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child ON node.key = child.key),
    sub AS (
        SELECT a.key[:u.d] AS key, count_if(n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
        FROM own a, unnest(range(a.depth + 1)) AS u(d) GROUP BY 1),
    ends AS (
        SELECT p.key, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids
        FROM p JOIN last USING (conv_id, depth) GROUP BY 1)
    SELECT o.conv_id, o.depth, up.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves::BIGINT AS n_leaves,
           saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM own o JOIN sub ON sub.key = o.key LEFT JOIN ends ON ends.key = o.key
    LEFT JOIN node up ON o.depth > 0 AND up.key = o.key[:o.depth - 1]"""
