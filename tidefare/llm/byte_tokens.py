"""Token ids of a byte-level BPE tokenizer, remembered word by word.

The tokenizer cuts a text by its own pattern before it merges bytes, and a space that a non-space
follows always begins a new piece. A text is therefore the chain of its words with the space before
each, and a word's ids are asked for once. Around any other white space the chain is cut only where that
rule holds.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import regex
from tokenizers import Tokenizer

from tidefare.llm.common import CACHED_WORDS

#: A space that belongs to what follows, and does not follow another space.
CUT = re.compile(r"(?<! ) (?=\S)")
#: Longer words are not remembered.
LONGEST_KEPT = 256


class Unsplit(Exception):
    """The text has white space that single spaces do not separate."""


def spaced_words(text: str) -> list[str]:
    """The text in parts, of which all but the first begin with a space; cut at some safe places, or at none."""
    starts = [0, *(found.start() for found in CUT.finditer(text) if found.start()), len(text)]
    return [text[a:b] for a, b in zip(starts[:-1], starts[1:])]


def byte_tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, if it is one that cuts and reads bytes as described."""
    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    cutter = settings["pre_tokenizer"] or {}
    if settings["normalizer"] or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True):
        raise ValueError(f"no plain byte-level tokenizer: {path}")
    return Tokenizer.from_file(path)


class ByteTokens(dict):
    """Ids (little-endian unsigned 32 bit) of words with a space before them."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = byte_tokenizer(path)
        self.pieces: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        # The pattern of this kind of tokenizer, and its printable form of bytes.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [byte for byte in range(256) if byte not in shown]
        self.printable = {byte: chr(byte) for byte in shown} | {byte: chr(256 + k) for k, byte in enumerate(hidden)}
        self.marks = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        value = self.pieces.get(piece)
        if value is None:
            if len(self.pieces) >= CACHED_WORDS:
                self.pieces.clear()
            found = self.model.tokenize(piece.encode().decode("latin-1").translate(self.printable))
            value = array("I", [token.id for token in found]).tobytes()
            if len(piece) <= LONGEST_KEPT:
                self.pieces[piece] = value
        return value

    def spelled(self, text: str) -> bytes:
        """The ids of a text in which special tokens' strings are plain text."""
        return b"".join(map(self.piece, self.pattern.findall(text)))

    def word(self, word: str) -> bytes:
        """The ids of a word with a space before it; letters alone, or letters and one mark, need no pattern."""
        if word.isalpha():
            return self.piece(" " + word)
        if word[-1] in ",.;:!?" and word[:-1].isalpha():
            return self.piece(" " + word[:-1]) + self.piece(word[-1])
        return self.spelled(" " + word)

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace():
            raise Unsplit
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self.word(word)
        if len(word) <= LONGEST_KEPT:
            self[word] = value
        return value

    def of(self, text: str) -> bytes:
        if not text:
            return b""
        if any(mark in text for mark in self.marks):
            return self.whole(text)
        first, *words = text.split(" ")
        try:
            rest = b"".join(map(self.__getitem__, words))
        except Unsplit:
            return b"".join(map(self.spelled, spaced_words(text)))
        return (self.spelled(first) if first else b"") + rest
