"""Token ids of whole texts, equal to the tokenizers library's, from a cache of text chunks.

Both vocabularies cut a text before tokenising: no token crosses from a character that is surely not
white space to a white-space character. A text is therefore split there, and what the library gives
for a chunk alone, it gives inside the text. Chunks repeat, so their ids are kept in a dictionary of
bounded size. A new chunk of plain Latin characters is cut by the vocabulary's own rule, and the ids of
its pieces are kept beside those of chunks, as a word comes with many marks around it; a new piece is
merged by the library's model. Any other chunk goes through the whole library, as does a text with rare
kinds of white space. Where the vocabulary lowers, a plain text is lowered before it is cut.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cache
from typing import ClassVar

import pyarrow as pa
from tokenizers import Tokenizer

#: Chunks kept per Python worker, and bytes, about, half of them young; when that half is full, it becomes the old
#: one, and the old one goes. It changes no result.
CACHE_SIZE, CACHE_BYTES = 500_000, 96 << 20

# What either library may take as white space, besides blank, tab, newline and carriage return.
_RARE_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2060\u3000\ufeff]")
_LATIN = r"a-zA-Z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u0148\u014a-\u017e"
_PLAIN = re.compile(rf"[ \t\n\r!-~{_LATIN}]*\Z")

# The two vocabularies' own cutting rules, with \p{L} and \p{N} written out for plain
# Latin text. What most often comes is tried first: alternatives of different first characters are in any order.
_LEADING_SPACE_RULE = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\s+(?!\S)|\s+"
)
_WORD_END_RULE = re.compile(rf"[{_LATIN}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\s{_LATIN}0-9]+")


def _byte_alphabet() -> dict[int, str]:
    """The byte-level vocabularies' printable stand-in of each byte."""
    kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}


_ALPHABET = _byte_alphabet()


class Vocabulary:
    """A vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not all(t["content"].startswith("<|") for t in spec["added_tokens"]):
            raise ValueError(f"special tokens of another form in {path}")
        self.drops_space = bool(spec["model"]["end_of_word_suffix"])
        self.lowers = spec["normalizer"] is not None
        self.rule = _WORD_END_RULE if self.drops_space else _LEADING_SPACE_RULE
        self.chunk_rule = re.compile(r"\S+" if self.drops_space else r"\s*\S+|\s+")

    def library_ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def chunks(self, text: str) -> list[str] | None:
        """The text cut where no token crosses; None if it has rare white space."""
        if self.lowers and "<|" not in text and _PLAIN.match(text):
            text = text.lower()
        elif _RARE_SPACE.search(text):
            return None
        return text.split() if self.drops_space else self.chunk_rule.findall(text)

    def cut(self, chunk: str) -> list[str] | None:
        """The pre-tokens of a plain chunk, each of which is a chunk that is cut into itself alone; None for
        any other chunk."""
        if chunk.isalpha() and chunk.isascii():
            return [chunk.lower() if self.lowers else chunk]
        if "<|" in chunk or not _PLAIN.match(chunk):
            return None
        return self.rule.findall(chunk.lower() if self.lowers else chunk)

    def pieces(self, chunk: str) -> list[str] | None:
        """The pre-tokens of a plain chunk in the byte alphabet; None for any other chunk."""
        cut = self.cut(chunk)
        return None if cut is None else list(map(self.spelled, cut))

    def spelled(self, piece: str) -> str:
        """A pre-token in the byte alphabet."""
        if piece.isascii() and self.drops_space:
            return piece
        return piece.encode().decode("latin-1").translate(_ALPHABET)

    def merged(self, piece: str) -> list[int]:
        return [t.id for t in self.model.tokenize(piece)]

    def chunk_ids(self, chunk: str) -> list[int]:
        pieces = self.pieces(chunk)
        if pieces is None:
            return self.library_ids(chunk)
        return [i for piece in pieces for i in self.merged(piece)]

    @property
    def whole_tokens(self) -> frozenset[str]:
        """Vocabulary strings, in the byte alphabet, that the library encodes alone as one token.

        Proved string by string: each is decoded to text, cut by the rule into itself alone, and
        encoded by the library to its own id.
        """
        back = {c: b for b, c in _ALPHABET.items()}
        found = []
        for string, number in self.library.get_vocab(with_added_tokens=False).items():
            try:
                text = bytes(back[c] for c in string).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if self.library_ids(text) == [number] and self.model.token_to_id(string) == number:
                found.append(string)
        return frozenset(found)


class Cache(dict):
    """What ``make`` gives for a chunk, kept for the next time. ``make`` may look up other chunks.

    A Python worker goes from one operator's tasks to another's, so an operator that starts calls
    ``alone`` to free what the caches of the others hold.
    """

    _of_worker: ClassVar[list[Cache]] = []

    def __init__(self, make, size: int = CACHE_SIZE):
        super().__init__()
        self.make, self.size, self.held, self.old = make, size, 0, {}
        self._of_worker.append(self)

    def alone(self) -> None:
        others = [c for c in self._of_worker if c is not self and (c or c.old)]
        for other in others:
            other.clear()
        if others:
            pa.default_memory_pool().release_unused()

    def __missing__(self, chunk):
        value = self.old.get(chunk)
        if value is None:
            value = self.make(chunk)
        if 2 * len(self) >= self.size or 2 * self.held >= CACHE_BYTES:
            old = dict(self)
            self.clear()
            self.old = old
        self[chunk] = value
        self.held += 160 + len(chunk) + (len(value) if isinstance(value, bytes) else 0)
        return value

    def clear(self) -> None:
        super().clear()
        self.held, self.old = 0, {}


class IdEncoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.cache = Cache(self.chunk)

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def chunk(self, chunk: str) -> bytes:
        cut = self.vocabulary.cut(chunk)
        if cut is None:
            return self.packed(self.vocabulary.library_ids(chunk))
        if cut == [chunk]:
            return self.packed(self.vocabulary.merged(self.vocabulary.spelled(chunk)))
        return b"".join(map(self.cache.__getitem__, cut))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        chunks = self.vocabulary.chunks(text)
        if chunks is None:
            return self.packed(self.vocabulary.library_ids(text))
        return b"".join(map(self.cache.__getitem__, chunks))


_id_encoder = cache(IdEncoder)


def id_encoder(path: str) -> IdEncoder:
    """One encoder per Python worker and vocabulary."""
    _id_encoder(path).cache.alone()
    return _id_encoder(path)
