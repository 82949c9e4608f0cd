"""Collocations, exact dedup and the prefix trie against brute force."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest_llm import CLASHES, DOCS, LOW, edge_texts, rows_of
from pluvio.llm import collocations, exact_dedup, prefix_trie

SPACE = re.compile("[\x20\x09-\x0d]+")


# ------------------------------------------------------------- exact dedup

def brute_groups(rows):
    of = defaultdict(list)
    for r in rows:
        of[SPACE.sub(" ", r[1] or "")].append(r[0])
    out = []
    for text, ids in of.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        for i in ids:
            out.append((i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def groups(df, **kw):
    rows = exact_dedup.exact_groups(df, **kw).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows), key=repr)


@pytest.mark.parametrize("kw", [
    {}, {"page_bytes": 3000}, {"page_bytes": 3000, "max_depth": 2},
    {"page_bytes": 3000, "max_depth": 4, "key": lambda t: F.length(t).cast("long")},
    {"page_bytes": 50_000, "key": lambda t: F.lit(-1).cast("long")}], ids=["plain", "split", "overflow", "chains", "one address"])
def test_exact_groups_match_brute_force(spark, edge_docs, kw):
    assert groups(edge_docs, **kw) == brute_groups([tuple(r) for r in edge_docs.select("doc_id", "text").collect()])


def test_exact_dedup_of_one_hot_text_and_of_nothing(spark, no_docs):
    rows = rows_of(["same  text\there"] * 400 + ["same text here"] * 3 + [f"t {i}" for i in range(50)])
    d = spark.createDataFrame(rows, DOCS).repartition(5)
    index = exact_dedup.exact_index(d, page_bytes=1000, max_depth=6)
    assert index.directory.agg(F.max("n_pages")).first()[0] > 1     # the hot text is dealt over pages
    assert groups(d, page_bytes=1000, max_depth=6) == brute_groups(rows)
    assert groups(no_docs) == []


def test_directory_splits_only_overfull_buckets(spark):
    loads = spark.createDataFrame([(0, 10), (1, 10), (2, 90), (3, 90), (12, 5)], "slot int, load long")
    got = {r.slot: (r.bucket, r.local_depth) for r in exact_dedup._doubled(loads, 100, 4).collect()}
    # 205 bytes split once; the lower half (200) splits down to single slots of 90, the rest stays
    assert got[12] == (1, 1) and got[0] == got[1] == (0, 3)
    assert got[2] == (2, 4) and got[3] == (3, 4)


# ------------------------------------------------------------ prefix trie

def brute_trie(rows):
    of = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            of[c].append((turn is not None, turn or 0, role or "", text or ""))
    conv = {c: [t[2:] for t in sorted(v)] for c, v in of.items()}
    full = {}
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(conv.get(c - int(c - 100 * int(c / 100)), [])[:h] + own[h:])
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        kids = {n for n in members if len(n) == len(node) + 1 and n[:-1] == node}
        leaves = sum(not any(m[:-1] == n and len(m) == len(n) + 1 for m in members) for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = sorted(c for c in convs if len(full[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids), leaves, saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(df, **kw):
    return sorted(map(tuple, prefix_trie.prefix_trie(df, **kw).collect()), key=repr)


def conversation_rows():
    rnd = random.Random(3)
    rows = []
    for c in [*range(0, 12), 100, 101, 150, 207, 208, -3, -103]:
        for t in range(rnd.randrange(0, 9)):
            rows.append((c, rnd.choice([t, t, None, 2]), rnd.choice(["user", "bot", None]), rnd.choice(["hi", "yes", None, "😀 ok"])))
    rows += [(5, i, "user", "again") for i in range(70)]                # long
    rows += [(6, 1, "user", "hi"), (6, 1, "user", "hi"), (None, 1, "user", "x"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("kw", [{}, {"band": 2, "block": 3}], ids=["plain", "many bands"])
def test_prefix_trie_matches_brute_force(spark, kw):
    rows = conversation_rows()
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    for i, name in enumerate((*CLASHES, "depth", "pos", "band", "path", "k1", "base")):
        d = d.withColumn(name, F.lit(i))
    assert trie(d, **kw) == brute_trie(rows)


def test_prefix_trie_of_one_conversation_with_many_copies(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(600, 1200) for t in range(4)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = trie(d)
    full = {g[1]: g for g in got if g[0] == 600}
    ends = ",".join(str(c) for c in range(600, 1200))
    assert len(got) == 5 and full[4][7] == hashlib.sha256(ends.encode()).hexdigest()
    assert full[0][3:7] == (600, 1, 1, 599 * 8)


def test_prefix_trie_of_nothing(spark):
    assert trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")) == []


def test_chunks_join_across_many_ids(spark, monkeypatch):
    batch = prefix_trie._table([(1, 2, 3, c) for c in range(10)], (*prefix_trie.NODE, "conv_id"), prefix_trie.pa.int64())
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    hashed = list(prefix_trie._hashed(prefix_trie._chunks(iter([batch]))))
    assert hashed[0].column("ends_sha256").to_pylist() == [hashlib.sha256(b"0,1,2,3,4,5,6,7,8,9").hexdigest()]


# ------------------------------------------------------------ collocations

def brute_collocations(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    if 100 * a >= 80 * c[p[i:i + m]]:
                        gone.add(p[i:i + m])
        scored = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def phrase_docs():
    rnd = random.Random(9)
    words = ["New", "york", "the", "of", "über", "x", "state", "a", "naïve", "co-op"]
    texts = [" ".join(rnd.choice(words) + rnd.choice(["", "", "", ",", ".\n", "\t"]) for _ in range(rnd.randrange(0, 80)))
             for _ in range(60)]
    texts += ["new york state"] * 15 + ["over and over and over and over"] * 4 + [" ".join(["the"] * 300)]
    return [(t, rnd.choice(["en", "de", None, "", "en"])) for t in texts + edge_texts()]


@pytest.mark.parametrize("kw", [{}, {"budget": 60, "block_words": 300}, {"budget": 2, "block_words": 40}, {"top": 7}],
                         ids=["plain", "groups", "extended prefixes", "top"])
def test_collocations_match_brute_force(spark, kw):
    rows = phrase_docs()
    d = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    for i, name in enumerate((*CLASHES, "key", "word", "f", "group", "a", "rank", "phrase")):
        d = d.withColumn(name, F.lit(i))
    got = sorted(map(tuple, collocations.collocations(d, least=4, **kw).collect()))
    assert got == brute_collocations(rows, 4, kw.get("top", 2000))


def test_collocations_of_nothing(spark, no_docs):
    assert collocations.collocations(no_docs).collect() == []


def test_score_products_may_pass_64_bits(spark):
    big = 9_000_000_000_000_000
    words = spark.createDataFrame([("en", 1, "a", big), ("en", 2, "b", big)], "lang string, key long, word string, f long")
    p = spark.createDataFrame([(1, 2, 0, 0, big - 1)], "w1 long, w2 long, w3 long, w4 long, a long")
    r = collocations._scored(p, words).first()
    assert r.score == 2000000 * (big - 1) // (2 * big)


def test_bit_table_misses_no_member(spark):
    rnd = random.Random(1)
    keys = [rnd.getrandbits(64) - (1 << 63) for _ in range(5000)] + [0, -1, (1 << 63) - 1, -(1 << 63)]
    import numpy as np
    t = collocations.BitTable.of(spark.createDataFrame([(k,) for k in keys], "key long"), "key")
    assert t.has(np.array(keys, np.int64).view(np.uint64)).all()
    other = np.array([rnd.getrandbits(64) for _ in range(5000)], np.uint64)
    assert t.has(other).mean() < 0.2
