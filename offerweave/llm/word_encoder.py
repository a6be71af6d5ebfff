"""Ids of texts under a tokenizer that drops white space, one white-space separated chunk at a time.

Such a tokenizer (here word_bpe_49k.json: NFC, lower case, tokens never cross white space) gives a text the ids of
its chunks one after another, special strings included since they hold no white space. A worker therefore keeps
the ids of chunks it has met, and calls the library for the others only: the model itself for plain words, whose
normalised form is known, and the whole tokenizer for everything else.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

# fixed values: the byte-level alphabet of the tokenizer's pre-tokenizer
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: b if b in _VISIBLE else 256 + sum(x not in _VISIBLE for x in range(b)) for b in range(256)}

CACHED = 500_000  # chunks in the young half of a worker's cache; the old half holds as many at most
LONGEST = 64  # bytes of a chunk that is kept: a text without white space is one chunk, and may be of any length


class ChunkEncoder:
    """ids(chunk) as bytes of unsigned 16- or 32-bit integers, cached."""

    def __init__(self, path: str, cached: int = CACHED) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.width = "H" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.cached = cached

    def _plain(self, s: str) -> list[int]:
        mapped = s.lower().encode().decode("latin-1").translate(_BYTE_CHARS)
        return [t.id for t in self.model.tokenize(mapped)]

    def ids(self, chunk: bytes) -> list[int]:
        s = chunk.decode()
        word = s.rstrip(",.")
        # precomposed Latin letters are stable under NFC; U+0130 has a lower case of two characters
        if word.isalpha() and max(word) < "ɐ" and "İ" not in word:
            tail = s[len(word) :]
            return self._plain(word) + (self._plain(tail) if tail else [])
        return self.tokenizer.encode(s, add_special_tokens=False).ids

    def missed(self, chunk: bytes) -> bytes:
        if (known := self.old.get(chunk)) is None:
            known = array(self.width, self.ids(chunk)).tobytes()
        if len(chunk) > LONGEST:
            return known
        if len(self.young) >= self.cached:
            self.old, self.young = self.young, {}
        self.young[chunk] = known
        return known

    def text(self, text: bytes) -> bytes:
        """The ids of a whole text."""
        chunks = text.split()
        found = list(map(self.young.get, chunks))
        if None in found:
            for k, x in enumerate(found):
                if x is None:
                    found[k] = self.young.get(chunks[k]) or self.missed(chunks[k])
        return b"".join(found)


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """One for each worker process, which keeps its cache from task to task."""
    return ChunkEncoder(path)
