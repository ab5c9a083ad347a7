"""Pre-tokens of the public BPE vocabularies and a bounded cache of their ids, for use inside tasks.

A file of the tokenizers library is read where the task runs; its path is a parameter. Only these two layouts are known:
byte-level (no normaliser, one splitting pattern) and lower-cased words with word ends. Texts with characters for which
the fast normalisation isn't proven equal go through the library's own normaliser.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from functools import lru_cache

import regex

BYTE_FILE, WORD_FILE = "byte_bpe_50k.json", "word_bpe_49k.json"
#: The splitting pattern of the byte-level vocabulary, as its library documents it.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The classes of both patterns among the first 256 characters, where the faster engine's own classes differ.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"
#: The same splits: nothing that begins with a letter or digit can begin with an apostrophe, so these may be tried first.
_ENDING = "'(?:s|t|re|ve|m|ll|d)"
_LATIN_BYTE = re.compile(f" ?[{_L}]+| ?[{_N}]+|{_ENDING}| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_LATIN_WORD = re.compile(f"[{_L}]+|[{_N}]|{_ENDING}|[^{_S}{_L}{_N}]+")
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Bytes as the vocabularies write them: printable ones as they are, the others from 256 on.
_KEPT = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_PRINTABLE = {b: b for b in _KEPT} | {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _KEPT)}
#: Entries of either half of the cache and characters of the words it keeps, which bound its memory; only speed depends on them.
CACHE, CACHED = 100_000, 48


def vocabulary_path(name: str) -> str:
    """The place of a vocabulary file: in TOKENIZER_DIR if set, else where the public package has it."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self._special = regex.compile("|".join(sorted(map(regex.escape, self.special), key=len, reverse=True))) if self.special else None
        self.folds = spec["normalizer"] is not None
        if self.folds:
            if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != _WORD_PATTERN:
                raise ValueError(f"{path} splits words by another pattern")
            self._pattern, self._latin = regex.compile(_WORD_PATTERN), _LATIN_WORD
        else:
            self._pattern, self._latin = regex.compile(BYTE_PATTERN), _LATIN_BYTE
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _normal(self, text: str) -> str:
        if not self.folds:
            return text
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()  # the library folds each character by itself

    def _split(self, text: str) -> list[str]:
        text = self._normal(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._pattern.findall(text)
        return self._latin.findall(text)

    def parts(self, text: str):
        """(text without special tokens, None) and ("", id of a special token), in order."""
        if self._special is None or not self._special.search(text):
            yield text, None
            return
        at = 0
        for m in self._special.finditer(text):
            if m.start() > at:
                yield text[at : m.start()], None
            yield m.group(), self.special[m.group()]
            at = m.end()
        if at < len(text):
            yield text[at:], None

    def words(self, text: str) -> list[str]:
        """The pre-tokens; a special token stands as itself and is told apart by ids_of()."""
        if self._special is None or not self._special.search(text):
            return self._split(text)
        out: list[str] = []
        for part, special in self.parts(text):
            out += [part] if special is not None else self._split(part)
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of pre-tokens, each by itself."""
        return [array("I", x).tolist() for x in self.encode_bytes(words)]

    def encode_bytes(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens, each by itself, as little-endian unsigned 32-bit integers.

        The library's model takes bytes as printable characters; what comes before it in the library is done by words().
        """
        tokenize, table, special, out = self.library.model.tokenize, _PRINTABLE, self.special, []
        for w in words:
            ids = [special[w]] if w in special else [t.id for t in tokenize(w.encode("utf-8", "surrogatepass").decode("latin-1").translate(table))]
            out.append(array("I", ids).tobytes())
        return out

    def word_bytes(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens as little-endian unsigned 32-bit integers; new ones are encoded once and kept."""
        out = list(map(self.cache.get, words))
        if None in out:
            new = {w for w, got in zip(words, out, strict=True) if got is None}
            kept = {w: self.older[w] for w in new if w in self.older}
            fresh = [w for w in new if w not in kept]
            kept.update(zip(fresh, self.encode_bytes(fresh), strict=True))
            out = [kept[w] if got is None else got for w, got in zip(words, out, strict=True)]
            if len(self.cache) + len(kept) > CACHE:  # words that come again move on, the others go with the older half
                self.cache, self.older = {}, self.cache
            self.cache.update((w, got) for w, got in kept.items() if len(w) <= CACHED)
        return out

    def ids(self, text: str | None) -> bytes:
        return b"".join(self.word_bytes(self.words(text))) if text else b""

    @property
    def pieces(self) -> list[bytes]:
        return _pieces(self)


@lru_cache(4)
def _pieces(encoder: Encoder) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    back = {chr(c): b for b, c in _PRINTABLE.items()}
    out = [b""] * encoder.size
    for token, i in encoder.library.get_vocab(with_added_tokens=True).items():
        out[i] = token.encode() if token in encoder.special else bytes(back[c] for c in token)
    return out


@lru_cache(4)
def encoder(path: str) -> Encoder:
    """One for each task process and file."""
    return Encoder(path)
