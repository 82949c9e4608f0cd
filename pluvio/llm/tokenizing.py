"""Encode texts with a public tokenizer file, one library call per new word.

A text is cut where the tokenizer can never look across: the cut rule of each
kind is proven in its docstring and tested against whole-text calls. Cutting,
telling pieces apart (by 64-bit hash within a slice of about a megabyte) and
laying out the ids are numpy passes over a slice; only its distinct pieces are
looked up. The ids of a piece are kept as little-endian unsigned 32-bit bytes in
a bounded table, so a frequent word is encoded once per worker.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from pluvio.llm.words import fold_ascii, hash_ranges, text_buffers, word_spans

#: Characters other than ASCII white space that some library counts as white space;
#: a text that holds one is encoded whole.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Leading UTF-8 bytes of such characters.
_MAYBE_ODD = np.zeros(256, dtype=bool)
_MAYBE_ODD[[*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_PLAIN = re.compile(r"[ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+\Z")
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[np.frombuffer(b".,;:!?|*$%&#<>", dtype=np.uint8)] = True

SLICE_BYTES = 1 << 20
KNOWN_PARTS = 300_000
MAX_PART_CHARS = 64


class PartTable:
    """Bounded table from text parts to id bytes, filled by ``encode``.

    Two generations of at most ``KNOWN_PARTS`` entries: a part that is met again
    moves to the young one, the old one is dropped whole. Long parts are not kept."""

    def __init__(self, encode: Callable[[str], bytes]):
        self._encode = encode
        self._young: dict = {}
        self._old: dict = {}

    def look_up(self, parts: list) -> list[bytes]:
        """Ids of each part; a known part costs one look-up."""
        young, old = self._young, self._old
        found = [*map(young.get, parts)]
        if None in found:
            for i in range(found.index(None), len(found)):
                if found[i] is None:
                    part = parts[i]
                    ids = young.get(part) or old.get(part) or self._encode(part)
                    if len(part) <= MAX_PART_CHARS:
                        young[part] = ids
                    found[i] = ids
        if len(young) > KNOWN_PARTS:
            self._young, self._old = {}, young
        return found


def _letters(data: np.ndarray) -> np.ndarray:
    """Whether a byte belongs to a letter A-Z, a-z or À-ÿ (but not × and ÷)."""
    nxt = np.append(data[1:], np.uint8(0))
    lead = (data == 0xC3) & (nxt >= 0x80) & (nxt <= 0xBF) & (nxt != 0x97) & (nxt != 0xB7)
    out = _LETTER[data] | lead
    out[1:] |= lead[:-1]
    return out


def piece_spans(data: np.ndarray, off: np.ndarray, keep_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ascending byte ranges of the pieces of texts that lie at ``off``: words,
    cut after leading letters that a mark follows; with ``keep_space`` a word
    brings the white space before it along, and what ends a text is a piece."""
    start, end, first = word_spans(data, off)
    other = np.append(np.flatnonzero(~_letters(data)), len(data))
    stop = other[np.searchsorted(other, start)]
    cut = (stop > start) & (stop < end)
    cut[cut] = _MARK[data[stop[cut]]]
    begin = start
    tail_from = tail_to = np.zeros(0, np.int64)
    if keep_space:
        begin = np.append(0, end[:-1]) if len(end) else start
        some = np.diff(first) > 0
        begin[first[:-1][some]] = off[:-1][some]
        last = off[:-1].copy()
        last[some] = end[first[1:][some] - 1]
        tail = last < off[1:]
        tail_from, tail_to = last[tail], off[1:][tail]
    lo = np.concatenate([begin, stop[cut], tail_from])
    hi = np.concatenate([np.where(cut, stop, end), end[cut], tail_to])
    order = np.argsort(lo, kind="stable")
    return lo[order], hi[order]


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PieceEncoder:
    """Ids of texts for one tokenizers-library file, as ``<u4`` bytes.

    ``keep_space=True`` (byte-level BPE): the pre-tokenizer's pattern only ever
    attaches white space to what follows it, so a text may be cut between a
    non-space and the ASCII space after it, and after a lone line break.
    ``keep_space=False`` (lower-casing word-end BPE): white space is dropped and
    no match holds any, so the words can be encoded one by one, A-Z folded
    before. NFC never composes over white space or with ASCII punctuation.
    In both, a run of letters ends before ASCII punctuation. A piece of letters
    only is one pre-token; it goes to the file's merge model directly.
    With ``added_tokens`` the string of an added token in a text is that token, as
    the library has it unless told otherwise: a text that holds one is encoded
    whole. Without, such strings are ordinary text.
    """

    def __init__(self, path: str, keep_space: bool, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        # pieces are never added tokens, not even one that becomes such a string by folding
        self._tok.encode_special_tokens = True
        added = self._tok.get_added_tokens_decoder().values()
        if any(t.normalized or not t.special for t in added):
            raise ValueError("unknown kind of added token")
        self._added = [t.content.encode() for t in added] if added_tokens else []
        self._model = self._tok.model
        self._letters = _byte_letters()
        self._keep_space = keep_space
        if self._tok.normalizer is not None and (
                keep_space or self._tok.normalizer.normalize_str("AÀß") != "aàß"):
            raise ValueError("unknown normalizer")
        self._pieces = PartTable(self._piece)
        self._line_break = self._whole("\n") if keep_space else b""

    def _whole(self, text: str) -> bytes:
        return np.array(self._tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _whole_text(self, text: str) -> bytes:
        if not self._added:
            return self._whole(text)
        self._tok.encode_special_tokens = False
        try:
            return self._whole(text)
        finally:
            self._tok.encode_special_tokens = True

    def _with_added(self, data: np.ndarray, off: np.ndarray) -> set[int]:
        """Numbers of the texts that hold the string of an added token."""
        raw, out = data.tobytes(), set()
        for string in self._added:
            at = raw.find(string)
            while at >= 0:
                i = int(np.searchsorted(off, at, "right")) - 1
                inside = at + len(string) <= off[i + 1]  # not over the border of two texts
                if inside:
                    out.add(i)
                at = raw.find(string, int(off[i + 1]) if inside else at + 1)
        return out

    def _piece(self, part: bytes) -> bytes:
        piece = part.decode()
        if not _PLAIN.match(piece):
            return self._whole(piece)
        head = b""
        if piece[0] == "\n":  # a lone line break is a pre-token of its own
            head, piece = self._line_break, piece[1:]
        symbols = (piece if self._keep_space else piece.lower()).encode().decode("latin-1").translate(self._letters)
        ids = [t.id for t in self._model.tokenize(symbols)]
        return head + struct.pack(f"<{len(ids)}I", *ids)

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string column in a row (null counts as empty),
        and the n + 1 offsets of the texts."""
        data, off = text_buffers(column)
        marked = _MAYBE_ODD[data]
        odd = []
        if marked.any():
            marks = np.concatenate([[0], np.cumsum(marked)])
            odd = [i for i in np.flatnonzero(marks[off[1:]] > marks[off[:-1]]).tolist()
                   if _ODD.search(data[off[i]:off[i + 1]].tobytes().decode())]
        if self._added:
            odd = sorted(self._with_added(data, off).union(odd))
        ids, ends = self._encode(data if self._keep_space else fold_ascii(data), off)
        if odd:
            texts = np.split(ids, ends[1:-1])
            for i in odd:
                texts[i] = np.frombuffer(self._whole_text(data[off[i]:off[i + 1]].tobytes().decode()), "<u4")
            ids = np.concatenate(texts)
            ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        return ids, ends

    def _encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = piece_spans(data, off, self._keep_space)
        _, at, inverse = np.unique(hash_ranges(data, lo, hi), return_index=True, return_inverse=True)
        raw = data.tobytes()
        found = self._pieces.look_up([raw[i:j] for i, j in zip(lo[at].tolist(), hi[at].tolist())])
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        before = (np.cumsum(size) - size)[inverse]
        n = size[inverse]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.arange(ends[-1]) + np.repeat(before - ends[:-1], n)]
        return ids, ends[np.searchsorted(lo, off)]


_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, keep_space: bool) -> PieceEncoder:
    """The worker's encoder of a file, with the file's added tokens; loaded once
    per Python worker."""
    key = (path, keep_space)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, keep_space, added_tokens=True)
    return _encoders[key]
