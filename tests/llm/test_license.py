import random

import pytest
from conftest_llm import DOCS, rows_of

from pluvio.llm import license_scan as L


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], max(row[j + 1], row[j], last + (x == y))
    return row[-1]


def test_alignment_is_a_common_subsequence():
    rnd = random.Random(1)
    exact = 0
    for _ in range(400):
        a = [rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(1, 14))]
        b = [rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(0, 20))]
        pairs = L.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) <= longest_common(a, b)
        exact += len(pairs) == longest_common(a, b)
    assert exact > 300


def test_alignment_of_an_edited_template_is_longest():
    rnd = random.Random(2)
    template = L.plain_words(L.TEMPLATES["GPL-3.0"])
    for _ in range(50):
        b = [w for w in template if rnd.random() > 0.05]
        for _ in range(3):
            b.insert(rnd.randrange(len(b)), f"new{rnd.randrange(99)}")
        assert len(L.align(template, b)) == longest_common(template, b)


def test_increasing_subsequence():
    rnd = random.Random(3)
    for _ in range(200):
        values = rnd.sample(range(50), 12)
        got = [b for _, b in L._increasing(list(enumerate(values)))]
        best = [1] * 12
        for i in range(12):
            best[i] = 1 + max((best[j] for j in range(i) if values[j] < values[i]), default=0)
        assert got == sorted(got) and len(got) == max(best)


def test_notices_are_found_anywhere(spark):
    filler = [f"w{i}" for i in range(3000)]
    texts, want = [], set()
    for name, t in L.TEMPLATES.items():
        i = len(texts)
        texts += [t, " ".join(filler) + "\n" + t.replace(" ", "\n * ") + "\n" + " ".join(filler),
                  "the of and " * 200 + t + " the of and" * 200, t + " " + t]
        want |= {(i + k, name) for k in range(4)}
    rows = L.license_scan(spark.createDataFrame(rows_of(texts), DOCS)).collect()
    got = {(r["doc_id"], r["license"]) for r in rows}
    assert got == want
    first = {(r["doc_id"], r["license"]): r for r in rows}
    r = first[(1, "MIT-notice")]
    assert (r["coverage"], r["n_matched"]) == (1.0, 5) and r["first_word"] == 3000


def test_other_texts_are_left_alone(spark, edge_docs, no_docs):
    texts = ["the license of a version under the public work is free", "Licensed under nothing", None, "",
             "licensed " + " ".join(f"x{i}" for i in range(50)) + " under the apache license version 2.0"]
    assert L.license_scan(spark.createDataFrame(rows_of(texts), DOCS)).count() == 1  # six words of seven in one place
    assert L.license_scan(edge_docs).count() == 0 and L.license_scan(no_docs).count() == 0


@pytest.mark.parametrize("text, want", [
    ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0-notice"}),
    ("This work is licensed under the GNU General Public License, version 9.", set()),
    (L.TEMPLATES["GPL-3.0"].replace("version 3", "version 2"), {"GPL-2.0"}),
    (L.TEMPLATES["GPL-3.0"].replace("version 3", "version 7"), set()),
    (L.TEMPLATES["GPL-3.0"].replace("General", "Affero General"), {"AGPL-3.0"}),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", {"CC-BY-4.0"}),
    ("Licensed under the Apache License, Version 1.1.", {"Apache-1.1-notice"}),
    ("Code is licensed under CC BY-SA 4.0, text is licensed under CC BY-NC 4.0.",
     {"CC-BY-SA-4.0-notice", "CC-BY-NC-4.0-notice"}),
    (L.TEMPLATES["MIT"] + " " + L.TEMPLATES["GPL-2.0"] + " " + L.TEMPLATES["GPL-3.0"], {"MIT", "GPL-2.0", "GPL-3.0"}),
    (L.TEMPLATES["Apache-2.0"] + "\n" + " ".join(f"x{i}" for i in range(30)) + "\n" + L.TEMPLATES["Apache-2.0-notice"],
     {"Apache-2.0", "Apache-2.0-notice"}),
])
def test_versions_are_told_apart(text, want):
    assert {row[0] for row in L.Scanner(L.TEMPLATES).scan(text)} == want


def test_rows_against_every_window():
    """Clear cases: a planted notice is the window that shares most words in order."""
    rnd = random.Random(8)
    scanner = L.Scanner(L.TEMPLATES)
    names = [n for n, t in L.TEMPLATES.items() if len(L.plain_words(t)) >= 11]
    for _ in range(25):
        name = rnd.choice(names)
        template = scanner.templates[name]
        gone = rnd.choice([None, *[i for i in range(len(template)) if i not in scanner.telling[name]]])
        own = [w for i, w in enumerate(template) if i != gone]
        words = [f"f{rnd.randrange(99)}" for _ in range(rnd.randrange(9, 40))]
        k = rnd.randrange(len(words))
        rows = scanner.scan(" ".join(words[:k] + own + words[k:]))
        best = {}
        text = words[:k] + own + words[k:]
        for n, t in scanner.templates.items():
            best[n] = max(longest_common(t, text[i:i + len(t) + 1]) for i in range(len(text))) / len(t)
        assert [r[0] for r in rows] == [name]
        assert rows[0][1] == len(own) / len(template) == best[name]
        assert (rows[0][3], rows[0][4]) == (k, k + len(own) - 1)


def test_edge_rows_that_hold_a_license(spark):
    notice = L.TEMPLATES["Apache-2.0-notice"]
    long = " ".join(f"w{i}" for i in range(30_000)) + " " + notice
    docs = spark.createDataFrame([(None, notice, 1), (5, notice, 2), (5, notice, 2), (6, long, 3), (7, None, 4)],
                                 "doc_id long, text string, coverage int")
    rows = L.license_scan(docs).collect()
    assert sorted((r["doc_id"] or 0, r["license"], r["first_word"]) for r in rows) == [
        (0, "Apache-2.0-notice", 0), *[(5, "Apache-2.0-notice", 0)] * 2, (6, "Apache-2.0-notice", 30_000)]
