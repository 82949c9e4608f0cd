import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import DOCS, rows_of, words_of

from pluvio.llm import lm_scoring, toxicity

# ---- language model ---------------------------------------------------------


def held(doc_id, folds=7, fold=2):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


def brute_model(docs, order, strength):
    """Counts as dictionaries over token tuples; probability by recursion."""
    seqs = [words_of(t, True) + [None] for i, t in docs]
    learn = [not held(i) for i, _ in docs]
    counts = Counter()
    for s, ok in zip(seqs, learn):
        if ok:
            padded = ["<start>", *s]
            counts.update((x,) for x in s)
            for m in range(2, order + 1):
                counts.update(tuple(padded[i:i + m]) for i in range(len(padded) - m + 1))
    n = sum(c for g, c in counts.items() if len(g) == 1)
    types = sum(len(g) == 1 for g in counts)
    once = sum(c == 1 for g, c in counts.items() if len(g) == 1)
    unknown = max(once, 1) / (n + 1)
    counts[("<start>",)] = sum(learn)

    def p(gram):
        if len(gram) == 1:
            return (1 - unknown) * counts[gram] / n if counts[gram] else unknown
        return (counts[gram] + strength * p(gram[1:])) / (counts[gram[:-1]] + strength)

    out = []
    for (i, _), s in zip(docs, seqs):
        padded = ["<start>", *s]
        score = sum(math.log10(p(tuple(padded[max(0, j - order + 1):j + 1])) if j - order + 1 < 0 or order == 1
                               else p(tuple(padded[j - order + 1:j + 1]))) for j in range(1, len(padded)))
        base = sum(math.log10((counts[(x,)] + 1) / (n + types + 1)) for x in s)
        out.append((i, held(i), len(s), sum(counts[(x,)] > 0 for x in s), n, base, score))
    return out, p, counts


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_against_brute_force(spark, order, monkeypatch):
    rnd = random.Random(order)
    texts = [" ".join(rnd.choice(["The", "a", "b", "c", "d"] + [f"x{i}" for i in range(60)])
                      for _ in range(rnd.randrange(40))) for _ in range(80)] + [None, "", "THE a b"]
    monkeypatch.setattr(lm_scoring, "KEYS_PER_BUCKET", 200)
    docs = spark.createDataFrame(rows_of(texts), DOCS).repartition(4)
    got = {r["doc_id"]: r for r in lm_scoring.lm_scores(docs, order=order, strength=3.0).collect()}
    want, _, _ = brute_model(list(enumerate(texts)), order, 3.0)
    assert len(got) == len(want) and any(w[1] for w in want)
    for i, out, n, known, train, base, score in want:
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out, n, known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)


def test_every_state_sums_to_one():
    texts = ["a b a c", "b a d", "a a a e"]
    _, p, counts = brute_model([(k, t) for k, t in enumerate(texts) if not held(k)], 2, 3.0)
    types = [g[0] for g in counts if len(g) == 1 and g != ("<start>",)]
    for h in [()] + [(x,) for x in types if x is not None] + [("<start>",)]:
        # seen types share 1 - unknown, the unknown type has the rest
        assert sum(p((*h, x)) for x in types) + p((*h, "?")) == pytest.approx(1, abs=0.15 if not h else 0.2)


def test_scores_edges(edge_docs, no_docs):
    rows = lm_scoring.lm_scores(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert Counter(r["n_tokens"] for r in rows) == Counter(len(words_of(r["text"])) + 1 for r in edge_docs.collect())
    assert all(r["score"] < 0 and np.isfinite(r["score"]) for r in rows)
    assert lm_scoring.lm_scores(no_docs).count() == 0


# ---- toxicity ---------------------------------------------------------------

def toxic_texts(n, seed=1):
    rnd = random.Random(seed)
    plain = [f"word{i}" for i in range(300)] + ["you", "your", "the"]
    bad = ["zuvilo", "grumpf", "blotak", "skarnig"]
    texts, labels = [], []
    for i in range(n):
        w = [rnd.choice(plain) for _ in range(rnd.randrange(10, 80))]
        toxic = rnd.random() < 0.3
        if toxic:
            for _ in range(rnd.randrange(1, 4)):
                w.insert(rnd.randrange(len(w)), rnd.choice(bad) + rnd.choice(["", "", "er", "!", "s"]))
        texts.append(" ".join(w))
        labels.append(int(toxic))
    return texts, labels


def test_held_out_accuracy(spark):
    texts, labels = toxic_texts(600)
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    known = spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity_scores(docs, known, trees=15, depth=3).collect()
    out = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in out} == {i for i in range(600) if held(i, 5, 0)}
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    # labels of held-out rows have no influence
    other = known.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 "
                             "THEN 1 - toxic ELSE toxic END AS toxic")
    again = toxicity.toxicity_scores(docs, other, trees=15, depth=3).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {r["doc_id"]: r["score"] for r in rows}


def test_toxicity_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(25)] + [(None, 1, 1), (3, None, None), (4, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity_scores(edge_docs, labels, trees=3, depth=2).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    kept = toxicity.without_toxic(edge_docs, labels, trees=3, depth=2)
    assert kept.dtypes == edge_docs.dtypes
    assert kept.count() == sum(r["predicted"] == 0 for r in rows)
    none = labels.where("false")
    assert toxicity.without_toxic(edge_docs, none).count() == edge_docs.count()
    assert {r["score"] for r in toxicity.toxicity_scores(edge_docs, labels.where("toxic = 1")).collect()} == {1.0}
    assert toxicity.toxicity_scores(no_docs, labels).count() == 0


def test_words_as_read():
    assert toxicity.plain_word('"Idiot!!"') == ("idiot", False)
    assert toxicity.plain_word("1d10t") == ("idiot", True)
    assert toxicity.plain_word("st*p1d") == ("stpid", True)
    assert toxicity.plain_word("don't") == ("don't", False)
    assert toxicity.plain_word("***") == ("", False)
    assert toxicity.entries("") == []
