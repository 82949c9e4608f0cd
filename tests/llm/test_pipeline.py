import inspect

import corpus_pipeline
import __spark_entry__ as E
import duckdb
import pytest

from pluvio.llm import minhash_dedup, quality_rules, toxicity
from pluvio.llm.queries import ORACLE, QUERIES, table

SF = "/root/testdata/sf0.001"


def test_registration():
    names = E.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in corpus_pipeline.STAGES)


def test_stages_take_effect(spark, tmp_path):
    docs = table(spark, SF, "documents")
    seen = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(f"{tmp_path}/{i}")
        seen.append(spark.read.parquet(f"{tmp_path}/{i}"))
    ids = [{r["doc_id"] for r in d.select("doc_id").distinct().collect()} for d in seen]
    assert all(d.schema == docs.schema for d in seen[:-1])
    bad = {r["doc_id"] for r in quality_rules.quality_rules(seen[0]).where("not kept").collect()}
    assert ids[1] == ids[0] - bad and bad
    toxic = {r["doc_id"] for r in toxicity.toxicity_scores(seen[1], table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert ids[2] == ids[1] - toxic
    copies = {r["doc_id"] for r in minhash_dedup.minhash_groups(seen[2], shingle=5, percent=80).where("not kept").collect()}
    assert ids[3] == ids[2] - copies
    assert ids[4] == ids[3] and ids[5] == ids[4]


def test_run_returns_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_cover_their_tables(spark, name):
    rows = QUERIES[name](spark, SF)
    if name == "op3_license_scan":
        assert rows.count() > 0
    elif name == "op2_embedding_dedup":
        assert rows.count() == table(spark, SF, "embeddings").count()
    elif name == "op13_prefix_trie":
        assert rows.where("depth = 0").first()["n_convs"] == table(spark, SF, "conversations").select("conv_id").distinct().count()
    elif name == "op11_collocations":
        words = table(spark, SF, "documents").selectExpr("lang", "size(split(trim(regexp_replace(text, '[ .,;:!?\t-\r]+', ' ')), ' ')) as n")
        assert {r["lang"]: r["n"] for r in rows.collect()}.items() <= {
            r["lang"]: r["n"] for r in words.groupBy("lang").agg({"n": "sum"}).toDF("lang", "n").collect()}.items()
    else:
        assert rows.select("doc_id").distinct().count() == table(spark, SF, "documents").count()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rows = QUERIES[name](spark, SF)
    want = con.sql(ORACLE[name])
    assert sorted(rows.columns) == sorted(want.columns)
    assert sorted(map(repr, map(tuple, rows.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


@pytest.mark.parametrize("name", ["quality_rules", "substring_dedup", "packing", "minhash_dedup"])
def test_stages_on_edge_rows(spark, edge_docs, no_docs, name):
    """Nulls, empty, very long and repeated rows and clashing columns; empty tables."""
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, no_docs, SF).count() == 0
    out = stage(spark, edge_docs, SF)
    rows, n = out.collect(), edge_docs.count()
    if name == "packing":
        assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in edge_docs.select("doc_id").collect()}
        return
    assert out.schema == edge_docs.schema
    texts = [r["text"] for r in rows]
    if name == "quality_rules":
        assert len(rows) < n and None not in texts and "" not in texts
    elif name == "substring_dedup":
        assert len(rows) == n and None in texts
    else:
        assert 0 < len(rows) < n and None in texts and any(r["doc_id"] is None for r in rows)


def test_near_dedup_stage_takes_five_words(spark):
    """Scattered single-word edits: over 80 % on four words, under it on five."""
    words = [f"w{i}" for i in range(404)]
    edited = [f"x{i}" if i % 40 == 20 else w for i, w in enumerate(words)]

    def shares(size):
        a, b = ({tuple(t[i:i + size]) for i in range(len(t) - size + 1)} for t in (words, edited))
        return 100 * len(a & b) / len(a | b)

    assert shares(5) < 80 <= shares(4)
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(words) + " end")],
                                 "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["minhash_dedup"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, SF).collect()) == [1, 2]
    assert [r["doc_id"] for r in minhash_dedup.minhash_groups(docs).where("kept").collect()] == [1]
