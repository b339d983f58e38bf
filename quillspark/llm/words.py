"""Ids of the tokenizers library for whole texts, each distinct word encoded once a worker.

The vocabulary drops white space, so no token spans it: a text's ids are those of its
words in turn. A word that a worker has not met is normalised and parted as the
vocabulary's file says, and the library's model encodes the parts; ids of words and parts are
kept, up to a bound. Words with characters from U+0300 on, where normalisation can do more than lower
a letter, are given to the library whole.

Special tokens are what they are for the library as loaded: their strings in a text are parted off first and are one id each.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

#: Words, and parts, whose ids a worker keeps in a newer and in an older table each. Once the newer one is full it becomes the older one; what is met
#: again there moves to the newer one, so common words stay and a worker's memory does not grow with the input.
KEPT = 200_000
#: A full stop or comma that could be one token with what is before it.
_JOINED_MARK = re.compile("[^0-9a-zªµºß-öø-ÿ][.,]")
_PARTED = tuple((mark + blank, f" {mark}{blank}") for mark in ".," for blank in " \n")


def _byte_letters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordEncoder(dict):
    """Encodes as ``Tokenizer.encode(text, add_special_tokens=False)`` does for a vocabulary whose white
    space only parts words. Ids are packed little-endian 32-bit. The dictionary itself holds the words met."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        kinds = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        splits = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        #: Whether parting words here is what the file asks for; otherwise the library gets words whole.
        self.known = kinds == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in splits] == ["Split", "ByteLevel"] and splits[0]["invert"]
        self.find = regex.compile(splits[0]["pattern"]["Regex"]).findall if self.known else None
        self.letters = _byte_letters()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        #: Whether cutting a text at the bare strings of its special tokens is all that the library does about them.
        self.plain_special = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.parts: dict[str, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.older_parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        packed = self.parts.get(part)
        if packed is not None:
            return packed
        packed = self.older_parts.get(part)
        if packed is None:
            spelled = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.letters)
            packed = np.array([t.id for t in self.model.tokenize(spelled)], dtype="<u4").tobytes()
        if len(self.parts) >= KEPT:
            self.parts, self.older_parts = {}, self.parts
        self.parts[part] = packed
        return packed

    def __missing__(self, word: bytes) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            packed = self._word(word)
        if len(self) >= KEPT:
            self.older = dict(self)
            self.clear()
        self[word] = packed
        return packed

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if self.known and (word.isascii() or max(text) < "\u0300"):
            text = text.lower()
            if text.isalpha():
                return self._part(text)
            if text[-1] in ".," and text[:-1].isalpha():
                return self._part(text[:-1]) + self._part(text[-1])
            return b"".join(map(self._part, self.find(text)))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _words(self, text: str) -> list[bytes]:
        """The words of a text, or of a text that has the same ids and repeats its words more: in
        Latin-1 letters are only lowered, and marks after a letter or digit are tokens of their own."""
        if self.known:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text.encode().split()
            text = text.lower()
            if not _JOINED_MARK.search(text):
                for mark, parted in _PARTED:
                    text = text.replace(mark, parted)
        return text.encode().split()

    def _text(self, text: str) -> bytes:
        if self.cut and self.cut.search(text):
            if not self.plain_special:
                return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
            return b"".join(self.special.get(x) or self._text(x) for x in self.cut.split(text))
        return b"".join(map(self.__getitem__, self._words(text)))

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        return list(map(self._text, texts))


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    """One encoder for all tasks that a Python worker runs in turn."""
    return WordEncoder(path)
