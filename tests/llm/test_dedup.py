import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import DOCS, rows_of, words_of
from pyspark.sql import functions as F

from pluvio.llm import embedding_dedup, minhash_dedup, substring_dedup
from pluvio.llm.blocks import by_bucket, document_blocks, pack_array, unpack_array
from pluvio.llm.components import connected_components


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


# ---- components -------------------------------------------------------------

@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)],
    [(5, 3), (9, 3), (9, 8), (20, 21), (21, 20), (None, 4)],
    [(random.Random(1).randrange(400), random.Random(i).randrange(400)) for i in range(300)]])
def test_components(spark, links):
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = roots({x for p in real for x in p}, real)
    assert {r["node"]: r["component"] for r in got.collect()} == want and got.count() == len(want)


# ---- MinHash ----------------------------------------------------------------

def shingles(text, size=4):
    w = words_of(text, True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def near_copies(seed, groups=6, members=12, words=90):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(words)]
        for _ in range(members):
            t = list(base)
            for _ in range(rnd.randrange(0, 7)):
                t[rnd.randrange(len(t))] = rnd.choice(vocabulary)
            texts.append(" ".join(t))
        texts.append(" ".join(base).upper())
    rnd.shuffle(texts)
    return texts


def check_groups(rows, docs):
    """Rows of equal (id, text) are one node; the smallest id reachable counts."""
    sets = {(d["doc_id"], d["text"]): shingles(d["text"]) for d in docs if d["doc_id"] is not None}
    keys = [k for k, s in sets.items() if s]
    index = {}
    for k in keys:
        for s in sets[k]:
            index.setdefault(s, []).append(k)
    common = Counter((a, b) for ks in index.values() for a in ks for b in ks if a < b) if len(keys) < 3000 else {}
    links = [(a, b) for (a, b), c in common.items()
             if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c)]
    number = {k: i for i, k in enumerate(sorted(keys))}
    root = roots(range(len(keys)), [(number[a], number[b]) for a, b in links])
    name = sorted(keys)
    want = Counter()
    for d in docs:
        k = (d["doc_id"], d["text"])
        c = name[root[number[k]]][0] if k in number else d["doc_id"]
        want[(d["doc_id"], len(sets.get(k, shingles(d["text"]))), c)] += 1
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)
    assert got == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"] or r["doc_id"] is None) for r in rows)


@pytest.mark.parametrize("block_docs", [1024, 4])
def test_near_copies_against_brute_force(spark, block_docs):
    """With blocks of 4 the groups are wide: first block, then the outsiders."""
    docs = spark.createDataFrame(rows_of(near_copies(block_docs)), DOCS).repartition(3)
    rows = minhash_dedup.minhash_groups(docs, block_docs=block_docs).collect()
    check_groups(rows, docs.collect())


def test_near_copies_edges(edge_docs, no_docs):
    check_groups(minhash_dedup.minhash_groups(edge_docs).collect(), edge_docs.collect())
    kept = minhash_dedup.first_of_groups(edge_docs)
    assert kept.schema == edge_docs.schema
    rows = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    groups = minhash_dedup.minhash_groups(edge_docs).where("kept").count()
    assert sum(rows.values()) == groups - 1 and max(rows.values()) == 1  # one repeated row goes
    assert rows[(None, "no id here")] == 1 and rows[(None, None)] == 1
    assert minhash_dedup.minhash_groups(no_docs).count() == 0 and minhash_dedup.first_of_groups(no_docs).count() == 0


def test_signature_agreement_estimates_similarity():
    rnd = np.random.default_rng(4)
    errors = []
    for share in (0.2, 0.5, 0.8):
        for _ in range(60):
            n = 120
            both = rnd.integers(1, 2**63, size=int(n * share), dtype=np.uint64)
            a, b = (np.unique(np.concatenate([both, rnd.integers(1, 2**63, size=(n - len(both)) // 2, dtype=np.uint64)]))
                    for _ in range(2))
            s = minhash_dedup.super_minhash([a, b], 140)
            truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append((s[0] == s[1]).mean() - truth)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < np.sqrt(0.25 / 140)  # below independent permutations at their worst


def test_signatures_fill_every_lane():
    s = minhash_dedup.super_minhash([np.array([5], np.uint64), np.zeros(0, np.uint64), np.arange(1, 9, dtype=np.uint64)], 140)
    assert sorted((s[0] >> np.uint64(56)).tolist()) == list(range(140))
    assert (s[1] == np.iinfo(np.uint64).max).all()
    assert ((s[2] >> np.uint64(56)) < 140).all()


# ---- substring --------------------------------------------------------------

def brute_spans(texts, size):
    docs = [words_of(t) for t in texts]
    count = Counter(tuple(w[i:i + size]) for w in docs for i in range(len(w) - size + 1))
    out = []
    for w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g), gone))
    return out


@pytest.mark.parametrize("size", [1, 3, 35])
def test_spans_against_brute_force(spark, size, monkeypatch):
    rnd = random.Random(size)
    passages = [" ".join(f"p{k}_{i}" for i in range(50)) for k in range(4)]
    texts = [" ".join(rnd.choice(passages) if rnd.random() < 0.2 else f"w{rnd.randrange(6 if size < 35 else 4000)}"
                      for _ in range(rnd.randrange(60))) for _ in range(60)]
    monkeypatch.setattr(substring_dedup, "KEYS_PER_BUCKET", 300)
    docs = spark.createDataFrame(rows_of(texts), DOCS).repartition(5)
    rows = {r["doc_id"]: r for r in substring_dedup.repeated_spans(docs, size).collect()}
    for i, (n, removed, kept, gone) in enumerate(brute_spans(texts, size)):
        r = rows[i]
        assert (r["n_words"], r["n_removed"], r["kept_text"]) == (n, removed, kept)
        mask = [False] * n
        for f in r["factors"]:
            assert f["words"] >= size
            mask[f["start"]:f["start"] + f["words"]] = [True] * f["words"]
        assert mask == gone


def test_spans_edges(edge_docs, no_docs):
    rows = substring_dedup.repeated_spans(edge_docs).collect()
    texts = [r["text"] for r in edge_docs.collect()]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert Counter((r["n_words"], r["n_removed"], digest(r["kept_text"])) for r in rows) == Counter(
        (n, g, digest(k)) for n, g, k, _ in brute_spans(texts, 35))
    clean = substring_dedup.without_repeats(edge_docs)
    assert clean.schema == edge_docs.schema
    want = Counter(k if g else t for t, (_, g, k, _) in zip(texts, brute_spans(texts, 35)))
    assert Counter(r["text"] for r in clean.collect()) == want
    assert substring_dedup.repeated_spans(no_docs).count() == 0 and substring_dedup.without_repeats(no_docs).count() == 0


def test_blocks_hold_every_row_once(edge_docs):
    for size in (1, 2000, 1 << 22):
        b = document_blocks(edge_docs, block_bytes=size)
        assert b.agg(F.sum("n_docs")).first()[0] == edge_docs.count()


def test_packed_arrays_and_buckets():
    for a in (np.array([], np.uint64), np.array([0, 1, 2**64 - 1], np.uint64), np.arange(-5, 5), np.array([7], np.uint8)):
        assert np.array_equal(unpack_array(pack_array(a)), a) and unpack_array(pack_array(a)).dtype == a.dtype
    keys = np.sort(np.random.default_rng(1).integers(0, 2**63, size=1000, dtype=np.uint64) * np.uint64(2))
    for n in (1, 2, 7, 100):
        cut = by_bucket(keys, n)
        assert len(cut) == n + 1 and cut[0] == 0 and cut[-1] == len(keys) and (np.diff(cut) >= 0).all()


# ---- vectors ----------------------------------------------------------------

def brute_vectors(rows):
    ok = [i for i, (v, e, label) in enumerate(rows) if v is not None and label is not None and e
          and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    unit = {i: np.array(rows[i][1], np.float64) / np.linalg.norm(rows[i][1]) for i in ok}
    links = [(i, j) for i in ok for j in ok if i < j and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98]
    root = roots(range(len(rows)), links)
    degree = Counter(x for p in links for x in p)
    least = {}
    for i in ok:
        least[root[i]] = min(least.get(root[i], rows[i][0]), rows[i][0])
    return Counter((v, degree[i], least[root[i]] if i in unit else v) for i, (v, _, _) in enumerate(rows))


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors_against_brute_force(spark, block):
    rnd = np.random.default_rng(block)
    f = lambda x: [float(y) for y in np.asarray(x, np.float32)]
    rows, n = [], 0
    for label in range(3):
        for _ in range(150):
            rows.append((n, f(rnd.standard_normal(16)), label))
            n += 1
    centre = rnd.standard_normal(16)
    for spread, count, label in ((0.02, 120, 1), (0.045, 80, 2)):  # denser than a window; ragged border
        for _ in range(count):
            rows.append((n, f(centre + spread * rnd.standard_normal(16) * np.linalg.norm(centre)), label))
            n += 1
    rows += [(n + i, rows[3][1], rows[3][2]) for i in range(40)]
    n += 40
    special = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, []]
    rows += [(n + i, e, 1) for i, e in enumerate(special)]
    n += len(special)
    rows += [(None, rows[3][1], rows[3][2]), (n, rows[3][1], None), (n + 1, f(np.ones(5)), 1), (n + 2, f(2 * np.ones(5)), 1),
             rows[3], (n + 3, [-x for x in rows[3][1]], rows[3][2])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    d = d.withColumn("cid", F.lit(1)).withColumn("n_links", F.lit(2)).withColumn("grp", F.lit("x"))
    got = embedding_dedup.vector_links(d, block_vectors=block).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute_vectors(rows)
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("spread", [0.0, 0.8, 0.9])
def test_pairs_in_a_topical_cluster(spark, spread):
    """All vectors of a label at a pairwise cosine of about ``spread``: most signs
    agree for all of them. Many partitions, so many borders in the order."""
    rnd = np.random.default_rng(int(100 * spread))
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(spread**0.5 * unit(rnd.standard_normal(64)) + (1 - spread)**0.5 * unit(rnd.standard_normal((3000, 64))))
    side = rnd.standard_normal((400, 64))
    side = unit(side - (side * x[:400]).sum(axis=1, keepdims=True) * x[:400])
    x = np.concatenate([x, 0.981 * x[:400] + (1 - 0.981**2)**0.5 * side]).astype(np.float32)
    d = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 24)
    try:
        got = embedding_dedup.vector_links(d, block_vectors=128).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    near = unit(x.astype(np.float64)) @ unit(x.astype(np.float64)).T >= 0.98
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate((near.sum(axis=1) - 1).tolist()))


def test_bits_that_a_window_needs():
    """Against a direct count: all rows that share the needed bits are in the window."""
    rnd = np.random.default_rng(5)
    key = np.sort(rnd.integers(0, 2**12, 300) << 50)
    for starts, ends in ((True, True), (False, False)):
        bits = embedding_dedup._needed_bits(key, 0, 4, starts, ends)
        for i, b in enumerate(bits.tolist()):
            same = lambda b: np.flatnonzero(key >> (62 - b) == key[i] >> (62 - b))  # noqa: E731, B023
            if b <= 62:
                assert np.abs(same(b) - i).max() <= 4 and (starts or (0 not in same(b) and 299 not in same(b)) or b == 0)
            if starts and b > 0:
                assert np.abs(same(b - 1) - i).max() > 4


def test_no_vectors(spark):
    d = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.vector_links(d).count() == 0


def test_passes_grow_with_the_label():
    n = [embedding_dedup.pass_count(x, 0.98) for x in (0, 1, 1000, 10**6, 10**9)]
    assert n == sorted(n) and n[0] >= 4 and n[-1] > n[2]
