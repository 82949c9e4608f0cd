"""Exact dedup by an extendible-hash index on shared files.

A text's address is the 64-bit hash of its normalised bytes. The directory maps
the first bits of an address to a bucket: it starts as one bucket, and as long as a
bucket holds more bytes of text than an owner task should, that bucket takes one
more address bit, which doubles the directory where its depth was exhausted. A
bucket that is still too full at the last depth (many copies of one text, or one
address) goes on as a chain of overflow pages, dealt over several owners.

Each page, a range of the address space, belongs to one owner task, which chains the
texts of an address and compares their bytes. The chains of all pages are written,
sorted by address, to the shared folder; a document finds its class through the
directory and its chain. All of it is DataFrame work inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.session import persist_table

#: Most address bits the directory reads: at most 2^16 slots, so it may be broadcast.
MAX_DEPTH = 16
#: Bytes of text in a page.
PAGE_BYTES = 32 << 20


def normalised(text: Column) -> Column:
    """Text with each run of ``0x20`` and ``0x09-0x0D`` as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def address(text: Column) -> Column:
    return F.xxhash64(text)


def slot(h: Column, depth: int) -> Column:
    """The first ``depth`` bits of an address."""
    return F.shiftrightunsigned(h, 64 - depth).cast("int") if depth else F.lit(0)


@dataclass
class ExactIndex:
    """``entries``: a row per document (doc_id, address, n_bytes, sha256).
    ``directory``: a row per slot (slot, bucket, local_depth, first_page, n_pages).
    ``chains``: a row per distinct text (bucket: its first page, address, chain,
    n_bytes, sha256, keep_id, group_size), sorted by address."""

    entries: DataFrame
    directory: DataFrame
    chains: DataFrame


def _doubled(loads: DataFrame, page_bytes: int, max_depth: int) -> DataFrame:
    """Directory over ``loads`` (slot, load), where slots have ``max_depth`` bits:
    rounds give every overfull bucket one more bit. A bucket is the slot prefix of its
    local depth. Every round is over at most 2^max_depth rows, written to the shared
    folder."""
    state = loads.select("slot", "load", F.lit(0).alias("bucket"), F.lit(0).alias("local_depth"))
    for depth in range(max_depth):
        full = (state.where(F.col("local_depth") == depth).groupBy("bucket")
                .agg(F.sum("load").alias("held")).where(F.col("held") > page_bytes))
        # at most one row per slot: a bounded table
        split = F.col("held").isNotNull()
        state = persist_table(state.join(F.broadcast(full.select("bucket", F.lit(depth).alias("local_depth"), "held")),
                                         ["bucket", "local_depth"], "left").select(
            "slot", "load",
            F.when(split, F.shiftright("slot", max_depth - depth - 1)).otherwise(F.col("bucket")).alias("bucket"),
            F.when(split, depth + 1).otherwise(F.col("local_depth")).alias("local_depth")), "directory")
        if state.where(F.col("local_depth") > depth).isEmpty():
            break
    return state


def _with_pages(state: DataFrame, page_bytes: int) -> DataFrame:
    """Numbers the pages in the order of the address space: one per bucket, more
    where the bucket is overfull at the last depth. At most one row per slot goes
    through the window."""
    held = state.groupBy("bucket", "local_depth").agg(F.sum("load").alias("held"), F.min("slot").alias("lowest"))
    pages = F.greatest(F.lit(1), F.ceil(F.col("held") / page_bytes).cast("int"))
    held = held.withColumn("n_pages", pages)
    before = F.sum("n_pages").over(Window.orderBy("lowest").rowsBetween(Window.unboundedPreceding, -1))
    held = held.withColumn("first_page", F.coalesce(before, F.lit(0)).cast("int"))
    return state.select("slot", "bucket", "local_depth").join(
        F.broadcast(held.select("bucket", "local_depth", "first_page", "n_pages")), ["bucket", "local_depth"])


def exact_index(docs: DataFrame, page_bytes: int = PAGE_BYTES, max_depth: int = MAX_DEPTH,
                key: Callable[[Column], Column] = address) -> ExactIndex:
    """Index of the whole texts of ``docs``; see the module docstring.

    Null text counts as empty. A null ``doc_id`` never keeps a group that has an id.
    Repeated rows are copies. An empty table gives an empty index. Only ``doc_id`` and
    ``text`` are read, so other columns may have any name. Each text is shuffled once;
    copies are not combined before, but their pages are dealt over owners by size."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"))
    keyed = text.withColumn("address", key(F.col("norm")))
    entries = persist_table(keyed.select(
        "doc_id", "address", F.octet_length("norm").cast("long").alias("n_bytes"),
        F.sha2(F.encode("norm", "utf-8"), 256).alias("sha256")), "entries")
    loads = entries.groupBy(slot(F.col("address"), max_depth).alias("slot")).agg(
        (F.sum("n_bytes") + F.count(F.lit(1))).alias("load"))
    directory = persist_table(_with_pages(_doubled(persist_table(loads, "directory"), page_bytes, max_depth),
                                          page_bytes), "directory")
    n_pages = directory.agg(F.max(F.col("first_page") + F.col("n_pages"))).first()[0] or 1

    # the directory has at most 2^max_depth rows
    routed = keyed.withColumn("slot", slot(F.col("address"), max_depth)).join(F.broadcast(directory), "slot")
    page = F.col("first_page") + F.pmod(F.monotonically_increasing_id(), F.col("n_pages")).cast("int")
    owned = routed.select(page.alias("page"), F.col("first_page").alias("bucket"), (F.col("n_pages") > 1).alias("overflow"), "address",
                          "norm", "doc_id").repartitionById(n_pages, "page")
    # inside the owner: equal bytes of an address are one link of its chain
    links = owned.groupBy("page", "bucket", "overflow", "address", "norm").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    links = links.select("bucket", "overflow", "address", "keep_id", "group_size",
                         F.octet_length("norm").cast("long").alias("n_bytes"),
                         F.sha2(F.encode("norm", "utf-8"), 256).alias("sha256"),
                         F.when(F.col("overflow"), F.col("norm")).alias("norm"))
    links = persist_table(links, "links")
    # links of one text in several overflow pages meet, bytes compared again
    links = links.where(~F.col("overflow")).drop("norm", "overflow").unionByName(
        links.where("overflow").groupBy("bucket", "address", "norm", "n_bytes", "sha256").agg(
            F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")).drop("norm"))
    return ExactIndex(entries, directory, persist_table(_chained(links), "chains"))


def _chained(links: DataFrame) -> DataFrame:
    """Number the links of each address; two texts with one fingerprint are an error,
    as a document finds its link by it."""
    chain = Window.partitionBy("bucket", "address")
    same = F.count(F.lit(1)).over(Window.partitionBy("bucket", "address", "sha256"))
    checked = F.when(same > 1, F.raise_error(F.lit("two texts of one address share a SHA-256"))).otherwise(
        F.col("sha256"))
    return links.select(
        "bucket", "address", F.row_number().over(chain.orderBy("sha256")).alias("chain"), "n_bytes",
        checked.alias("sha256"), "keep_id", "group_size").sortWithinPartitions("bucket", "address", "chain")


def exact_groups(docs: DataFrame, **parameters) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256, n_bytes, chain)``: one row
    per input row, also for dropped ones.

    Texts are equal when identical after each run of whitespace became one space; of
    equal texts the row with the smallest ``doc_id`` stays. Null text is empty; a null
    id counts as larger than all others (a group without any id has a null
    ``keep_id``, and its rows stay); rows that repeat the smallest id stay with it;
    very long texts are compared whole; an empty table gives an empty result. See
    :func:`exact_index` for the parameters."""
    index = exact_index(docs, **parameters)
    found = index.entries.join(index.chains.drop("n_bytes"), ["address", "sha256"])
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        F.col("sha256").alias("text_sha256"), "n_bytes", "chain")


def oracle_sql() -> str:
    return r"""
    WITH d AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
    FROM d"""
