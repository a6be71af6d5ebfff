"""BPE by backtracking: longest token matches, checked against a table of compatible neighbours.

Byte-pair merging gives a text one sequence of tokens only in which every two neighbours are *compatible*: encoding
their joined bytes gives just these two. So the encoder walks through a piece of text with an Aho-Corasick
automaton over the vocabulary, takes the longest token that starts at the place reached, and accepts it if it is
compatible with the token before; otherwise it tries the next shorter token, and where none is left it takes back the
last token. A place that has been given up once is never tried again, so the work is linear in the text. The
result equals that of merging by rank (van Antwerpen and Neubeck describe the method in public).

Compatible(a, b): take a and b apart by their merges, step by step, and look whether a merge across the border
would have come before theirs. Answers are kept in a table.

Decoding: all tokens' bytes lie in one array; ids become (offset, size) by a table and are gathered at once.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.llm.words import buffers, slices

# fixed values: how this vocabulary's pre-tokenizer cuts a text
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# the same for texts of Latin-1 characters only, where Python's own engine does, several times faster
_L, _N, _S = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff", "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe", "\\t-\\r \\x85\\xa0"
LATIN_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
# fixed values: bytes that the file writes as themselves; all others as the characters from 256 on, in order
VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

CACHED = 600_000  # pieces in the young half of a worker's cache
PAIRS = 2_000_000  # answers in the table of compatible pairs
NONE = 1 << 62


class Bpe:
    """encode(text) to ids, decode(ids) to text."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        hidden = [b for b in range(256) if b not in VISIBLE]
        byte_of = {chr(b): b for b in VISIBLE} | {chr(256 + k): b for k, b in enumerate(hidden)}
        vocab = spec["model"]["vocab"]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, k in vocab.items():
            self.bytes[k] = token.encode() if token in self.added else bytes(byte_of[c] for c in token)
        for token, k in self.added.items():
            self.bytes[k] = token.encode()
        of = {self.bytes[k]: k for token, k in vocab.items() if token not in self.added}
        self.of = of
        # a token that merges make is split by the merge of lowest rank that makes it
        self.rank: dict[int, int] = {}  # (left << 32 | right) to the rank of their merge
        self.joined: dict[int, int] = {}
        self.split: dict[int, tuple[int, int, int]] = {}
        for n, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right, both = vocab[a], vocab[b], vocab[a + b]
            self.rank.setdefault(left << 32 | right, n)
            self.joined.setdefault(left << 32 | right, both)
            if both not in self.split:
                self.split[both] = (left, right, n)
        self.longest = ahocorasick.Automaton()
        for token, k in of.items():
            if len(token) > 1:  # a match ends at the last byte's place: its size counts from one further on
                self.longest.add_word(token.decode("latin-1"), (len(token) - 1, k))
        self.longest.make_automaton()
        self.single = [of[bytes([b])] for b in range(256)]
        # the longest shorter token that a token begins with
        self.shorter = {k: next((of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in of), -1) for t, k in of.items()}
        self.pairs: dict[int, bool] = {}
        self.never = frozenset(k for k in of.values() if not self._reached(k))
        self.pieces = regex.compile(PIECES)
        self.special = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # decoding
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)

    def compatible(self, left: int, right: int) -> bool:
        """Does merging the bytes of both give just these two tokens?"""
        key = left << 32 | right
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        # The border lies between the last part of left and the first part of right. Merges undo from the latest
        # to the earliest; a merge across the border that is due before one of theirs would have been made.
        rank, split = self.rank, self.split
        limit = NONE
        a, b = left, right
        while True:
            if rank.get(a << 32 | b, NONE) < limit:
                return False
            ra, rb = split.get(a), split.get(b)
            if ra is None and rb is None:
                return True
            if rb is None or ra is not None and ra[2] > rb[2]:
                a, limit = ra[1], ra[2]
            else:  # of two equal merges the right one is made later; a border merge of equal rank comes before it
                b, limit = rb[0], rb[2] + 1

    def piece(self, raw: bytes) -> list[int]:
        """Ids of a piece without special strings, by backtracking."""
        if (whole := self.of.get(raw)) is not None and whole not in self.never:
            return [whole]
        n, never = len(raw), self.never
        # longest token that starts at each place, from the automaton's matches by their ends
        best = [self.single[x] for x in raw]
        sizes = [0] * n
        for end, (size, k) in self.longest.iter(raw.decode("latin-1")):
            if size > sizes[at := end - size]:
                sizes[at], best[at] = size, k
        open_at = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, best[0]
        shorter, lengths, compatible = self.shorter, self.bytes, self.compatible
        while True:
            end = at + len(lengths[token])
            if open_at[end] and token not in never and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == n:
                    return out
                token = best[at]
            elif (token := shorter[token]) == -1:
                open_at[at] = 0
                if not out:
                    raise ValueError("a text that the vocabulary can't express")
                token = out.pop()
                at -= len(lengths[token])
                # the token taken back ends at a place given up, so the next turn tries a shorter one

    def _reached(self, token: int) -> bool:
        """Do merges of its own bytes make this token? A few vocabularies hold tokens that none make."""
        parts = [self.single[x] for x in self.bytes[token]]
        while len(parts) > 1:
            n, k = min((self.rank.get(parts[i] << 32 | parts[i + 1], NONE), i) for i in range(len(parts) - 1))
            if n == NONE:
                return False
            parts[k : k + 2] = [self.joined[parts[k] << 32 | parts[k + 1]]]
        return parts[0] == token

    def _missed(self, piece: str) -> bytes:
        known = self.old.get(piece)
        if known is None:
            known = array("I", self.piece(piece.encode())).tobytes()
        if len(self.young) >= CACHED:
            self.old, self.young = self.young, {}
        self.young[piece] = known
        return known

    def _ordinary(self, text: str) -> list[bytes]:
        try:
            text.encode("latin-1")
            pieces = LATIN_PIECES.findall(text)
        except UnicodeEncodeError:
            pieces = self.pieces.findall(text)
        found = list(map(self.young.get, pieces))
        if None in found:
            for k, x in enumerate(found):
                if x is None:
                    found[k] = self.young.get(pieces[k]) or self._missed(pieces[k])
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; special strings in it become their own ids."""
        if self.special is not None and any(x in text for x in self.added):
            out: list[bytes] = []
            for part in self.special.split(text):
                out += [array("I", [self.added[part]]).tobytes()] if part in self.added else self._ordinary(part)
        else:
            out = self._ordinary(text)
        return np.frombuffer(b"".join(out), np.uint32)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return b""
        return self.blob[np.arange(ends[-1]) + np.repeat(self.offsets[ids] - (ends - sizes), sizes)].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def bpe(path: str) -> Bpe:
    """One for each worker process, which keeps its caches from task to task."""
    return Bpe(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int), text_decoded for each row: the operator's real output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(path)
        for batch in slices(batches, "text"):
            ids = [own.encode(x or "") for x in batch.column(1).to_pylist()]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
            yield pa.record_batch([batch.column(0), lists, pa.array([own.decode(x) for x in ids])], ["doc_id", "ids", "text_decoded"])

    return _rows(docs).mapInArrow(run, "doc_id long, ids array<int>, text_decoded string")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row: every text encoded, and decoded from its ids.

    Null counts as the empty text (no ids, empty decoded text). Rows are independent; other columns aren't read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(path)
        decimal = np.array([f"{k}," for k in range(len(own.bytes))], "S")
        digits = np.char.str_len(decimal)
        blob = np.frombuffer(b"".join(decimal.tolist()), np.uint8)
        offsets = np.cumsum(digits) - digits
        for batch in slices(batches, "text"):
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                ids = own.encode(text or "")
                n.append(len(ids))
                sizes = digits[ids]
                ends = np.cumsum(sizes)
                listed = blob[np.arange(ends[-1]) + np.repeat(offsets[ids] - (ends - sizes), sizes)].tobytes()[:-1] if len(ids) else b""
                ids_sha.append(hashlib.sha256(listed).hexdigest())
                text_sha.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
