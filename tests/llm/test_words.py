import numpy as np
import pyarrow as pa
from conftest_llm import LOW, edge_texts, words_of

from pluvio.llm.words import batch_words, sequence_hash, slices, window_hashes, window_starts


def test_words_match_the_pattern():
    texts = edge_texts()
    for fold in (False, True):
        w = batch_words(pa.array(texts, pa.string()), fold_case=fold)
        got = [[bytes(w.data[w.start[j]:w.end[j]]).decode() for j in range(w.first[i], w.first[i + 1])]
               for i in range(len(texts))]
        assert got == [words_of(t, fold) for t in texts]
        flat = [x for t in got for x in t]
        by = {}
        for x, h in zip(flat, w.hashes.tolist()):
            assert by.setdefault(x, h) == h
        assert len(set(by.values())) == len(by)


def test_hashes_do_not_depend_on_the_batch():
    texts = edge_texts()
    whole = batch_words(pa.array(texts, pa.string())).hashes
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    for size in (1, 50, 100_000):
        parts = [batch_words(b.column(0)).hashes for b in slices(iter([batch]), max_bytes=size)]
        assert np.array_equal(np.concatenate(parts), whole)


def test_windows_stay_inside_a_document():
    w = batch_words(pa.array(["a b c d", "", "b c d", None, "a", "a b c"]))
    h, at = window_hashes(w, 3)
    assert at.tolist() == [0, 1, 4, 8] and at.tolist() == window_starts(w.first, 3).tolist()
    assert h[0] == h[3] and h[1] == h[2] and h[0] != h[1]
    assert sequence_hash(w.hashes[4:7]) == int(h[1])
    assert LOW[65] == 97
