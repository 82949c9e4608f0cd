import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from conftest_llm import edge_texts
from tokenizers import Tokenizer

from pluvio.llm import packing, sentencepiece_codec, token_files
from pluvio.llm.tokenizing import PieceEncoder, encoder

FILES = {"byte_bpe_50k.json": True, "word_bpe_49k.json": False}


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def odd_texts(n):
    rnd = random.Random(2)
    alphabet = " \t\n\n\r\x0b\x0c\xa0\x1c aBÉé'sé́1!.,;<|endoftext|>ſΣßÀ̸▁漢\U0001f600"
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("name", FILES)
def test_piecewise_ids_equal_whole_text_ids(name):
    texts = [t for t in edge_texts() if len(t or "") < 20_000] + odd_texts(3000) + ["don't  we'll 's <|endoftext|>"]
    own, want = PieceEncoder(public_tokenizers.path(name), FILES[name]), library(name)
    for _ in range(2):  # the second time from the table
        ids, ends = own.encode_column(pa.array(texts, pa.string()))
        assert [t.tolist() for t in np.split(ids, ends[1:-1])] == [want(t) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_ids_equal_the_file_as_loaded(spark, name, tmp_path):
    """The library is not changed here: the string of an added token is that token."""
    lib = Tokenizer.from_file(public_tokenizers.path(name))
    want = lambda text: lib.encode(text or "", add_special_tokens=False).ids
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|><|endoftext|>b \n", "<|startoftext|> x",
             "<|ENDOFTEXT|> y", "<|endof", "text|> z", None, "\xa0<|endoftext|>\x1c", "plain words"]
    rnd = random.Random(6)
    texts += ["".join(rnd.choice(["<|endoftext|>", "<|startoftext|>", "<|Endoftext|>", "<|", "|>", " ", "\n", "a", "é", "'s"])
                      for _ in range(rnd.randrange(12))) for _ in range(500)]
    ids, ends = encoder(public_tokenizers.path(name), FILES[name]).encode_column(pa.array(texts, pa.string()))
    assert [t.tolist() for t in np.split(ids, ends[1:-1])] == [want(t) for t in texts]
    if FILES[name]:
        path = f"{tmp_path}/ids"
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        token_files.write_tokens(docs, path, public_tokenizers.path(name), True, 0, files=3)
        assert {r["doc_id"]: r["ids"] for r in token_files.read_tokens(spark, path).collect()} == {
            i: want(t) + [0] for i, t in enumerate(texts)}


def test_files_round_trip(spark, edge_docs, tmp_path):
    path = f"{tmp_path}/ids"
    token_files.write_tokens(edge_docs, path, public_tokenizers.path("byte_bpe_50k.json"), True, 0, files=4)
    rows = token_files.read_tokens(spark, path).orderBy("start").collect()
    want = library("byte_bpe_50k.json")
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["ids"]) for r in rows) == sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0, want(r["text"]) + [0]) for r in edge_docs.collect())
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in rows]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    sums = token_files.ids_crc32(token_files.read_tokens(spark, path)).collect()
    assert {r["start"]: r["ids_crc32"] for r in sums} == {
        r["start"]: zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows}


@pytest.mark.parametrize("coding", ["delta", "dictionary"])
def test_files_allow_selective_reads(spark, edge_docs, tmp_path, coding):
    path = f"{tmp_path}/ids"
    token_files.write_tokens(edge_docs, path, public_tokenizers.path("byte_bpe_50k.json"), True, 0,
                             coding=coding, files=2)
    kinds = set()
    for f in glob.glob(f"{path}/part-*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                if column.path_in_schema.startswith("ids"):
                    kinds.update(column.encodings)
                else:
                    assert column.has_offset_index and column.has_column_index
    assert ("DELTA_BINARY_PACKED" if coding == "delta" else "RLE_DICTIONARY") in kinds
    plan = token_files.read_tokens(spark, path).where("doc_id = 4").select("n_tokens")._jdf.queryExecution().toString()
    assert "GreaterThan" in plan or "EqualTo(doc_id,4)" in plan
    assert "ids" not in plan.split("ReadSchema: ")[-1].split("\n")[0]


def test_files_of_no_documents(spark, no_docs):
    d = token_files.token_file_digest(no_docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert d.count() == 0 and d.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_codec_equals_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    own, lib = sentencepiece_codec.PieceCodec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t for t in edge_texts() if len(t or "") < 100_000] + odd_texts(3000) + ["<s> <0x0A> ▁▁x", " " * 300, "ab" * 2000]
    for t in texts:
        ids = own.encode(t)
        assert ids == lib.encode(t or "")
        assert own.decode(ids) == lib.decode(ids)


def test_codec_cuts_are_exact_on_whole_chunks():
    """The splitter alone, on uncut text, agrees with the library too."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    own, lib = sentencepiece_codec.PieceCodec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for t in odd_texts(500):
        if t:
            pieces = [i for _, i in own.split("▁" + t.replace(" ", "▁")) if i >= 0]
            assert pieces == [i for i in lib.encode(t) if not lib.is_byte(i)]


def test_codec_over_a_table(edge_docs, no_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = sentencepiece_codec.decode_documents(
        sentencepiece_codec.encode_documents(edge_docs, path), path).collect()
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], r["ids"], r["text"]) for r in rows), key=key) == sorted(
        ((r["doc_id"], ids, lib.decode(ids)) for r in edge_docs.collect() for ids in [lib.encode(r["text"] or "")]), key=key)
    assert sentencepiece_codec.codec_digest(no_docs, path).count() == 0


def test_patterns_place_every_piece_once():
    rnd = random.Random(3)
    for seq_len in (8, 64, 2048):
        histogram = {}
        for _ in range(5000):
            n = min(seq_len, int(rnd.expovariate(3 / seq_len)) + 1)
            histogram[n] = histogram.get(n, 0) + 1
        patterns = packing.pack_patterns(histogram, seq_len)
        seen = {}
        for pattern, count in patterns:
            assert sum(pattern) <= seq_len and count > 0
            for n in pattern:
                seen[n] = seen.get(n, 0) + count
        assert seen == histogram
        used = sum(n * c for n, c in histogram.items())
        assert used / (seq_len * sum(c for _, c in patterns)) > {8: 0.8, 64: 0.97, 2048: 0.99}[seq_len]
    assert packing.pack_patterns({}, 8) == [] and packing.pack_patterns({8: 3}, 8) == [((8,), 3)]


@pytest.mark.parametrize("seq_len", [64, 2048])
def test_packed_documents(spark, edge_docs, seq_len):
    placed = packing.pack_documents(edge_docs, public_tokenizers.path("word_bpe_49k.json"), 1, seq_len)
    rows = placed.collect()
    want = library("word_bpe_49k.json")
    docs = sorted(tuple(want(r["text"]) + [1]) for r in edge_docs.collect())
    by_seq = {}
    for r in rows:
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= seq_len
    assert sum(r["length"] for r in rows) == sum(map(len, docs))
    single = [d for d in docs if docs.count(d) == 1 and len(d) > 1]
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["ids"]))
    joined = [tuple(x for _, ids in sorted(p) for x in ids) for p in by_doc.values()]
    assert set(single) <= set(joined)
    full = {r["sequence_id"]: r for r in packing.packed_sequences(placed, 0, seq_len).collect()}
    assert full.keys() == by_seq.keys()
    for r in full.values():
        n = r["n_used"]
        assert len(r["ids"]) == (n if n & (n - 1) == 0 else seq_len)


def test_packing_no_documents(no_docs):
    assert packing.pack_documents(no_docs, public_tokenizers.path("word_bpe_49k.json")).count() == 0
