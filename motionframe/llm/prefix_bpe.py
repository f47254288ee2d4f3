"""Byte-level BPE by dynamic programming over prefixes, and its inverse.

A text is cut at special tokens and then by the pattern of the vocabulary; each piece is encoded by itself. Of every
prefix of a piece the encoding has one last token, and it is the only suffix of the prefix, among the vocabulary's
tokens, that is compatible with the last token of what stands before it. An automaton over all tokens gives the suffixes
of each prefix in one pass; two tokens are compatible if no merge across their border comes before both sides are whole.
Following the last tokens back from the end gives the ids that repeated merging gives, in time that is linear in the
piece, however long.

Nulls: a null text is empty and has no ids; ids are carried through. Repeated rows are encoded one by one. Extra columns
are not read. Ids are kept as little-endian unsigned 32-bit integers in one binary value.
"""

from __future__ import annotations

import hashlib
import json

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from motionframe.llm.common import Recent, map_rows

#: Pieces that a worker remembers at once.
CACHE = 100_000
# White space as the vocabulary's pattern means it, and that pattern.
SPACE = r"\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in own}
    rest = [b for b in range(256) if b not in own]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixBPE:
    """Encoder and decoder for a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_chars()
        raw = lambda s: bytes(byte[c] for c in s)
        ids = {raw(s): i for s, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = {i: b for b, i in ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.find = regex.compile(PATTERN).findall
        parts = {}
        self.rank: dict[tuple[int, int], int] = {}
        for k, m in enumerate(spec["model"]["merges"]):
            left, right = (raw(s) for s in (m.split(" ") if isinstance(m, str) else m))
            pair = ids[left], ids[right]
            self.rank[pair] = k
            parts.setdefault(ids[left + right], (k, *pair))
        self.parts = parts
        self.made = len(spec["model"]["merges"])
        self.pairs = Recent(lambda pair: self._first_across(*pair) is None, CACHE)
        self.pieces = Recent(lambda piece: np.array(self.encode_piece(piece), dtype="<u4").tobytes(), CACHE)
        self.tokens = ahocorasick.Automaton()
        for b, i in ids.items():
            if i not in parts or self._first_across(*parts[i][1:]) == parts[i][0]:  # else merging never makes it
                self.tokens.add_word(b.decode("latin-1"), (i, len(b)))
        self.tokens.make_automaton()

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at a token's right (2) or left (1) edge, each with the rank of the merge that takes it in."""
        t, until, out = token, self.made, []
        while True:
            out.append((t, until))
            if t not in self.parts:
                return out
            until, t = self.parts[t][0], self.parts[t][side]

    def _first_across(self, a: int, b: int) -> int | None:
        """The rank of the first merge across the border of a and b, or None."""
        left = self._edge(b, 1)
        ranks = [m for x, x_until in self._edge(a, 2) for y, y_until in left if (m := self.rank.get((x, y))) is not None and m < x_until and m <= y_until]
        return min(ranks, default=None)

    def encode_piece(self, piece: str) -> list[int]:
        s = piece.encode().decode("latin-1")
        last = [None] * len(s)
        for end, (token, size) in self.tokens.iter(s):
            if last[end] is None and (size > end or self.pairs[last[end - size][0], token]):
                last[end] = (token, size)
        out, end = [], len(s) - 1
        while end >= 0:
            token, size = last[end]
            out.append(token)
            end -= size
        return out[::-1]

    def clear(self) -> None:
        self.pieces.clear()
        self.pairs.clear()

    def encode(self, text: str) -> bytes:
        if self.cut is None or not any(s in text for s in self.special):
            return b"".join([self.pieces[p] for p in self.find(text)])
        out = []
        for part in self.cut.split(text):
            out.append(self.special[part].to_bytes(4, "little") if part in self.special else b"".join([self.pieces[p] for p in self.find(part)]))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The text's UTF-8; bytes that are none become U+FFFD."""
        get = self.bytes.__getitem__
        return b"".join(map(get, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace").encode()


_loaded: dict[str, PrefixBPE] = {}


def loaded(path: str) -> PrefixBPE:
    if path not in _loaded:
        _loaded[path] = PrefixBPE(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, keep: list[str] = ["doc_id"], text_col: str = "text") -> DataFrame:
    """The columns `keep` and ids."""
    return map_rows(docs, keep, [text_col], [("ids", pa.binary())], lambda bpe, texts: ([bpe.encode(t or "") for t in texts],), lambda: loaded(path))


def decode(encoded: DataFrame, path: str, keep: list[str] = ["doc_id"], ids_col: str = "ids") -> DataFrame:
    """The columns `keep` and text."""
    return map_rows(encoded, keep, [ids_col], [("text", pa.string())], lambda bpe, ids: ([bpe.decode(i).decode() for i in ids],), lambda: loaded(path))


def _digests(bpe: PrefixBPE, ids):
    n = [len(i) // 4 for i in ids]
    return n, [hashlib.sha256(i).hexdigest() for i in ids], [hashlib.sha256(bpe.decode(i)).hexdigest() for i in ids]


FIELDS = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]


def round_trip(docs: DataFrame, path: str, keep: list[str] = ["doc_id"], text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The columns `keep`, n_tokens, and digests of the ids and of the text decoded from them, in one pass; ids if asked for."""

    def run(bpe: PrefixBPE, texts):
        ids = [bpe.encode(t or "") for t in texts]
        return (*((ids,) if with_ids else ()), *_digests(bpe, ids))

    return map_rows(docs, keep, [text_col], [*([("ids", pa.binary())] if with_ids else []), *FIELDS], run, lambda: loaded(path))
