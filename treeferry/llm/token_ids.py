"""Token ids of whole texts by the ``tokenizers`` library, fast enough for repeated words.

Both tokenizers used here split a text into pre-tokens before they merge anything, and no
pre-token crosses from a character into white space after it. So a text may be cut in front
of white space, and equal parts have equal ids wherever they stand. The ids of parts are
kept in a bounded cache per worker, and the library's model runs once for each new pre-token.
"""

from __future__ import annotations

import json
import re
import sys
import types
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

#: Entries of each cache before it starts anew. An entry takes about 250 bytes.
CACHE_ENTRIES = 600_000
#: Longer parts are encoded but not kept.
CACHED_CHARACTERS = 64

# White space as both pre-tokenizers know it, and their patterns.
SPACE = r"\t-\r \x85\xa0  -     　"
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters that this and the library's pattern engine are known to read alike (a test goes
# through them): Latin letters, and common punctuation. Letters that only one of the two knows
# would be cut at different places, so parts with any other character go to the library.
SHARED = re.compile("[\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac]*")
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself where it is
    printable in Latin-1, else the next free one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + i) for i, byte in enumerate(others)}


class TokenIds:
    """``encode(text)``: the ids as little-endian unsigned 32-bit integers.

    ``path``: a file of the ``tokenizers`` library. The ids are those of its
    ``encode(text, add_special_tokens=False)``. Texts that the cutting rule does not cover
    (special tokens' strings, normal forms that change under composition) and files of
    another kind go to that method whole, and so does each part between spaces that has a
    character outside ``SHARED``.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        steps = json.dumps([settings.get("normalizer"), settings.get("pre_tokenizer")])
        self.special = [token["content"] for token in settings.get("added_tokens", ())]
        self.lowers = "Lowercase" in steps
        self.whole_only = not ("ByteLevel" in steps and ("NFC" in steps) == self.lowers)
        self.pattern = regex.compile(WORD_LEVEL if self.lowers else BYTE_LEVEL)
        self.table = byte_characters()
        self.parts: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}
        self.cut = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")

    def encode(self, text: str) -> bytes:
        if self.whole_only or any(token in text for token in self.special):
            return self._whole(text)
        if self.lowers:
            # Lower-casing here must be by character, as there: a final sigma depends on its place.
            if "Σ" in text or not (text.isascii() or unicodedata.is_normalized("NFC", text)):
                return self._whole(text)
            words = text.replace("\n", " ")
            if _is_shared(text):
                return self._words(words.lower().split(" "), "")
            return b"".join([self._words([word.lower()], "") if _is_shared(word) else self._kept_whole(word) for word in words.split(" ")])
        return self._spaced(text)

    def _whole(self, text: str) -> bytes:
        return pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _kept_whole(self, part: str) -> bytes:
        """The library's ids of a part that it has to cut itself, kept like others."""
        ids = self.tokens.get(part)
        if ids is None:
            ids = self._whole(part)
            if len(part) <= CACHED_CHARACTERS:
                if len(self.tokens) >= CACHE_ENTRIES:
                    self.tokens.clear()
                self.tokens[part] = ids
        return ids

    def _words(self, words: list[str], before: str) -> bytes:
        parts = self.parts
        try:
            return b"".join([parts[word] for word in words])
        except KeyError:
            return b"".join([parts.get(word) or self._part(word, before) for word in words])

    def _spaced(self, text: str) -> bytes:
        """Parts that begin with a space, found by splitting at spaces; texts with a space
        after other white space are cut by a pattern instead."""
        first, *rest = text.split(" ")
        parts = self.parts
        try:
            return self._new(first) + b"".join([parts[word] for word in rest])
        except KeyError:
            pass
        if any(not word or word[-1].isspace() for word in (first, *rest)):
            return b"".join([parts.get(p[1:]) or self._part(p[1:], " ") if p[0] == " " and len(p) > 1 else self._new(p) for p in self.cut.findall(text)])
        return self._new(first) + b"".join([parts.get(word) or self._part(word, " ") for word in rest])

    def _part(self, word: str, before: str) -> bytes:
        """The ids of ``before + word``, kept under ``word``."""
        if not _is_shared(word):
            ids = self._whole(before + word)
            if not word or word[-1].isspace():
                return ids
        elif word.isalpha():
            ids = self._model(before + word)
        elif word[-1:] in (".", ",") and word[:-1].isalpha():
            ids = (self.parts.get(word[:-1]) or self._part(word[:-1], before)) + self._token(word[-1])
        else:
            ids = b"".join(map(self._token, self.pattern.findall(before + word)))
            # Splitting at spaces is right only before a part that ends in something else.
            if not self.lowers and (not word or word[-1].isspace()):
                return ids
        if len(word) <= CACHED_CHARACTERS:
            if len(self.parts) >= CACHE_ENTRIES:
                self.parts.clear()
            self.parts[word] = ids
        return ids

    def _new(self, part: str) -> bytes:
        if not _is_shared(part):
            return self._whole(part)
        return b"".join(map(self._token, self.pattern.findall(part)))

    def _token(self, token: str) -> bytes:
        ids = self.tokens.get(token)
        if ids is None:
            ids = self._model(token)
            if len(token) <= CACHED_CHARACTERS:
                if len(self.tokens) >= CACHE_ENTRIES:
                    self.tokens.clear()
                self.tokens[token] = ids
        return ids

    def _model(self, token: str) -> bytes:
        if token.isascii() and token.isprintable():
            written = token.replace(" ", self.table[32])  # the others are themselves
        else:
            written = token.encode().decode("latin-1").translate(self.table)
        return pack([t.id for t in self.tokenizer.model.tokenize(written)])


def _is_shared(text: str) -> bool:
    return text.isascii() or SHARED.fullmatch(text) is not None


def pack(ids: Iterable[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def tokenizer_path(name: str) -> str:
    """Where an installed public vocabulary lies; called where the tokenizer runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_tokens(name: str) -> TokenIds:
    """The tokenizer of this worker process, with its cache: workers outlive tasks."""
    held = sys.modules.setdefault("treeferry_worker_tokens", types.ModuleType("treeferry_worker_tokens"))
    if not hasattr(held, "by_name"):
        held.by_name = {}
    if name not in held.by_name:
        held.by_name[name] = TokenIds(tokenizer_path(name))
    return held.by_name[name]


def encoded(texts: Iterable[str | None], name: str, end: int) -> Iterator[bytes]:
    """The ids of each text and the end id; null is an empty text."""
    tokens, last = worker_tokens(name), pack([end])
    for text in texts:
        yield (tokens.encode(text) if text else b"") + last
