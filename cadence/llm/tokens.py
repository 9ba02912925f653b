"""Token ids by the tokenizers library, chunk by chunk with a bounded cache.

A text is cut only where no pre-token can span the cut, each distinct chunk is
encoded once by the library, and its ids are kept as packed bytes; a document
is the concatenation. The ids equal those of encoding the whole text.

* ``words`` cut (word vocabularies that drop white space): at every U+0020.
* ``spaced`` cut (byte-level vocabularies whose pre-tokens may take one leading
  space): before a U+0020 that stands between two non-space characters.

A line feed between two non-space characters is cut out likewise: it is a
pre-token of its own, or is dropped. Special tokens hold no white space, so they
never span a cut. A plain Latin word, and the ASCII marks after it, are one
pre-token each; a word goes to the library's BPE model directly, every other
chunk through its whole pipeline.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

#: Chunks kept in a worker; the cache starts anew beyond it.
CACHE_CHUNKS = 700_000
LONGEST_CACHED = 64

_TWO_SPACES = re.compile(r"\s\s")
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
_PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letter[b] for b in range(256)]


_LETTERS = {b: c for b, c in enumerate(_byte_letters())}


class _Chunks(dict):
    """Chunk -> packed ids, filled on demand."""

    def __init__(self, tokenizer, typecode: str, prefix: str = "", lower: bool = False, marks: dict | None = None,
                 most: int = CACHE_CHUNKS):
        super().__init__()
        self.most = most
        self.tokenizer, self.typecode, self.prefix, self.lower = tokenizer, typecode, prefix, lower
        self.model = tokenizer.model
        self.marks = self if marks is None else marks

    def __missing__(self, chunk: str) -> bytes:
        plain = _PLAIN_WORD.fullmatch(chunk)
        if plain and plain[2]:
            packed = self[plain[1]] + self.marks[plain[2]]
        elif plain:
            word = self.prefix + (chunk.lower() if self.lower else chunk)
            pieces = self.model.tokenize(word.encode().decode("latin-1").translate(_LETTERS))
            packed = array(self.typecode, [p.id for p in pieces]).tobytes()
        else:
            packed = array(self.typecode, self.tokenizer.encode(
                self.prefix + chunk, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= LONGEST_CACHED:
            if len(self) >= self.most:
                self.clear()
            self[chunk] = packed
        return packed


class TextEncoder:
    """Encodes whole texts to packed little-endian ids: two bytes an id when
    the vocabulary fits them, else four."""

    def __init__(self, path: str, cut: str, most: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        small = tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.dtype, typecode = ("<u2", "H") if small else ("<u4", "I")
        self.spaced = cut == "spaced"
        self.first = _Chunks(tokenizer, typecode, lower=not self.spaced, most=most)
        if self.spaced:
            self.rest = _Chunks(tokenizer, typecode, prefix=" ", marks=self.first, most=most)
            self.line_feed = self.first["\n"]

    def _line(self, line: str) -> bytes:
        if not line:
            return b""
        parts = line.split(" ")
        return self.first[parts[0]] + b"".join(map(self.rest.__getitem__, parts[1:]))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.spaced:
            return b"".join(map(self.first.__getitem__, text.replace("\n", " ").split(" ")))
        if _TWO_SPACES.search(text):
            parts = _INNER_SPACE.split(text)
            return self.first[parts[0]] + b"".join(map(self.rest.__getitem__, parts[1:]))
        return self.line_feed.join(map(self._line, text.split("\n")))


@lru_cache(maxsize=4)
def encoder(path: str, cut: str, most: int = CACHE_CHUNKS) -> TextEncoder:
    """One encoder per worker and vocabulary file, with at most ``most`` chunks kept."""
    return TextEncoder(path, cut, most)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file by name; a path stays as it is."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)
