"""SentencePiece merge-type (BPE) encoding and decoding by backtracking.

A sequence of pieces is the library's encoding exactly if every piece, and
every two neighbours, merge back to themselves. So the encoder walks left to
right with the longest piece that matches at a position (all matches come from
one Aho-Corasick pass), accepts it if it is compatible with the piece before,
tries the next shorter one otherwise, and steps back when none is left; a
bitfield marks positions known to fail, so no position is tried twice.
Compatibility is decided by re-merging the two pieces' text and kept in a table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from string import ascii_letters, punctuation

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.token_files import id_lists
from pluvio.llm.tokenizing import PartTable
from pluvio.llm.words import slices

SPACE = "▁"
MAX_PAIRS = 500_000


class PieceCodec:
    """Encoder and decoder of one merge-type model file (vocabulary and scores
    are read from it; the library's own encoder is not called).

    The model must use the plain normalizer (dummy prefix, spaces escaped) and
    byte fallback; others are refused.
    """

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " ﬁ ½  Å\t"
        if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model's normalizer changes texts")
        n = sp.vocab_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) for i in range(n)]
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self._byte_id = {int(pieces[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        if len(self._byte_id) != 256:
            raise ValueError("the model has no byte fallback")
        self._id = {p: i for i, p in enumerate(pieces) if not special[i]}
        self._score = {p: sp.get_score(i) for p, i in self._id.items()}
        self._bytes = [b"" if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self._bytes[sp.unk_id()] = " ⁇ ".encode()
        for value, i in self._byte_id.items():
            self._bytes[i] = bytes([value])
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self._id):
            raise ValueError("a piece goes on after a space")
        self._match = ahocorasick.Automaton()
        for p, i in self._id.items():
            self._match.add_word(p, (len(p), i))
        self._match.make_automaton()
        # merges never cross two characters that are neighbours in no piece, so a
        # text may be cut there: around these controls, before a space, and between
        # letters and these marks
        near = {p[i:i + 2] for p in self._id for i in range(len(p) - 1)}
        alone = "".join(c for c in "\t\n\x0b\x0c\r" if not any(c in p for p in self._id))
        letters = ascii_letters + "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))
        marks = "".join(c for c in punctuation
                        if not any(x + c in near or c + x in near for x in letters))
        stop, none = re.escape(alone), "(?!)"
        word, mark = f"[{letters}]+", f"[{re.escape(marks)}]+" if marks else none
        self._chunks = re.compile(
            (f"[{stop}]|" if alone else "")
            + f"{SPACE}*{word}(?=[{re.escape(marks)}{SPACE}{stop}]|\\Z)"
            + f"|{SPACE}*{mark}(?=[{letters}{SPACE}{stop}]|\\Z)"
            + f"|{SPACE}*[^{SPACE}{stop}]+|{SPACE}+")
        self._n, self._text = n, pieces
        self._fits: dict[int, bool] = {}
        self._parts = PartTable(self._chunk_ids)

    def _merge(self, text: str) -> list[str]:
        """Merge neighbours by best score, leftmost first, until none is a piece."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self._score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces (or with left < 0 the right one) re-merge to themselves."""
        key = (left + 1) * self._n + right
        ok = self._fits.get(key)
        if ok is None:
            if len(self._fits) >= MAX_PAIRS:
                self._fits.clear()
            want = [self._text[right]] if left < 0 else [self._text[left], self._text[right]]
            ok = self._merge("".join(want)) == want
            self._fits[key] = ok
        return ok

    def split(self, text: str) -> list[tuple[int, int]]:
        """``(characters, id)`` of the pieces of a normalized text; a character
        of no piece stays single with id -1."""
        n = len(text)
        options: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # ascending lengths
        for last, match in self._match.iter(text):
            options[last + 1 - match[0]].append(match)
        for o in options:
            if len(o) > 1:
                o.sort()
            elif not o:
                o.append((1, -1))
        failed = bytearray(n + 1)
        out: list[tuple[int, int]] = []
        level: list[int] = []  # option taken at each piece
        fits = self._compatible
        pos, k = 0, len(options[0]) - 1 if n else 0
        before = -1
        while pos < n:
            while k >= 0:
                length, piece = options[pos][k]
                if not failed[pos + length] and (
                        piece < 0 or (fits(-1, piece) and (before < 0 or fits(before, piece)))):
                    break
                k -= 1
            if k >= 0:
                out.append((length, piece))
                level.append(k)
                pos += length
                before = piece
                k = len(options[pos]) - 1 if pos < n else 0
            else:
                failed[pos] = 1
                if not out:
                    raise ValueError("no valid split")
                pos -= out.pop()[0]
                before = out[-1][1] if out else -1
                k = level.pop() - 1
        return out

    def _chunk_ids(self, chunk: str) -> bytes:
        ids: list[int] = []
        at = 0
        for length, piece in self.split(chunk):
            if piece < 0:
                ids.extend(self._byte_id[b] for b in chunk[at:at + length].encode())
            else:
                ids.append(piece)
            at += length
        return np.array(ids, dtype="<u4").tobytes()

    def ids_bytes(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        return b"".join(self._parts.look_up(self._chunks.findall(SPACE + text.replace(" ", SPACE))))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.ids_bytes(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, escaped spaces undone, dummy prefix off."""
        text = b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids)`` of every whole text. Null text counts as empty (no
    ids), rows without ``doc_id`` and repeated rows are kept, other columns are
    ignored, an empty table gives an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for rows in slices(batches):
            ids = [c.ids_bytes(t) for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), id_lists(ids)], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids array<int>")


def decode_documents(rows: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids, text)``: ids back to text. Null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for b in batches:
            texts = [c.decode(ids.as_py() or []) for ids in b.column(1)] if b.column(1).null_count else [
                c.decode(ids) for ids in _lists(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             names=["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def _lists(column: pa.Array) -> Iterator[list[int]]:
    values, off = np.asarray(column.values), np.asarray(column.offsets)
    for i, j in zip(off[:-1].tolist(), off[1:].tolist()):
        yield values[i:j].tolist()


def codec_digest(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of encode and decode."""
    r = decode_documents(encode_documents(docs, model), model)
    return r.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
                    .alias("ids_sha256"),
                    F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
