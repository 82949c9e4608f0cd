from collections import Counter

import duckdb
from conftest_llm import DOCS, WORD, rows_of

from pluvio.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_statistics_against_brute_force(edge_docs):
    rows = Q.quality_rules(edge_docs).collect()
    want = sorted(brute(r["text"]) for r in edge_docs.collect())
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(tuple(r[n] for n in names) for r in rows) == want
    assert all(not r["kept"] for r in rows if r["base_failed"])


def test_rules_reject_other_kinds_and_keep_prose(spark):
    prose = " ".join(f"the w{i} of x{i}y and z{i}" for i in range(30))
    texts = [prose, " ".join(f"word{i}***" for i in range(90)), " | ".join(f"c{i}ell" for i in range(90)),
             " ".join(f"WORDS{i}!!" for i in range(90)), "\n".join([prose] + ["same old line here"] * 20)]
    kept = {r["doc_id"]: r["kept"] for r in Q.quality_rules(spark.createDataFrame(rows_of(texts), DOCS)).collect()}
    assert kept[0] and not any(kept[i] for i in (1, 2, 3))
    assert [r["doc_id"] for r in Q.accepted(spark.createDataFrame(rows_of(texts), DOCS)).collect()] == [
        i for i in range(5) if kept[i]]


def test_accepted_keeps_columns_and_rows(edge_docs, no_docs):
    a = Q.accepted(edge_docs)
    assert a.schema == edge_docs.schema
    assert a.count() == Q.quality_rules(edge_docs).where("kept").count()
    assert Q.quality_rules(no_docs).count() == 0 and Q.accepted(no_docs).count() == 0


def test_one_projection_without_python_or_shuffle(edge_docs):
    plan = Q.quality_rules(edge_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Aggregate" not in plan.replace("RepartitionByExpression", "")


def test_sql_gives_the_same(spark):
    from pluvio.llm import queries
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = queries.QUERIES["op1_quality_rules"](spark, sf)
    cur = con.execute(queries.ORACLE["op1_quality_rules"])
    assert [d[0] for d in cur.description] == got.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(cur.fetchall())
