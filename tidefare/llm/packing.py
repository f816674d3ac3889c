"""Cost-balanced packing of token sequences.

Each task packs the documents it reads, a chunk of about four million tokens at a time, so no row is
shuffled and no task ever holds more than a chunk. Inside a chunk

1. whole runs of `capacity` tokens are cut from the front of longer documents; each fills a sequence;
2. what remains of a document costs `LINEAR * n + QUADRATIC * n**2` (feed-forward and attention
   work); in descending order of cost it goes to the sequence of lowest cost that still has room;
3. remainders that fit nowhere whole are cut to fill the room that is left.

The sequences of a chunk hold exactly its tokens: as many of `capacity` as fit, and for the tail one
for each power of two in it, which needs no padding either. The assignment depends on how the input
is split into tasks, as sequence numbers do (task number and running number); a rerun or a retried
task over the same files gives the same rows.

Null and empty texts have the end token only. Repeated rows are packed as often as they occur. An
empty table gives no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidefare.llm.common import CACHED_WORDS, slices, utf8

CAPACITY = 4096
END_TOKEN = 2
CHUNK_TOKENS = 4 << 20
#: Cost of n tokens in one document: linear work, and attention whose share equals it at 2,048 tokens.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
])


class WordTokens(dict):
    """Token ids (little-endian unsigned 32 bit) of words between white space.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    words in turn. Words of plain Latin letters go straight to the tokenizer's merge model, split by
    its own pattern; any other word passes through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}
        # The pattern that the vocabulary file names, and its printable form of bytes.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [byte for byte in range(256) if byte not in shown]
        self.printable = {byte: chr(byte) for byte in shown} | {byte: chr(256 + k) for k, byte in enumerate(hidden)}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        text = word.decode("utf-8")
        if max(text) < "Ā" and "<|" not in text and not any("\x1c" <= c <= "\x1f" or c in "\x85\xa0" for c in text):
            text = unicodedata.normalize("NFC", text).lower()
            # Letters alone, or letters and one mark, need no pattern.
            if text.isalpha():
                value = self._piece(text)
            elif text[-1] in ",.!" and text[:-1].isalpha():
                value = self._piece(text[:-1]) + self._piece(text[-1])
            else:
                value = b"".join(map(self._piece, self.pattern.findall(text)))
        else:
            value = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = value
        return value

    def _piece(self, piece: str) -> bytes:
        value = self.pieces.get(piece)
        if value is None:
            if len(self.pieces) >= CACHED_WORDS:
                self.pieces.clear()
            shown = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.printable)
            found = self.model.tokenize(shown)
            value = struct.pack(f"<{len(found)}I", *(token.id for token in found))
            self.pieces[piece] = value
        return value

    def of(self, text: bytes) -> bytes:
        if b"<|" in text:  # a special token's string may stand anywhere, even inside a word
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.split()))


def cost(tokens):
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(document index, start, length, sequence, offset) for documents of the given lengths."""
    pieces, sequences, rest = [], 0, []
    for document, length in enumerate(lengths):
        whole = length - length % capacity
        for start in range(0, whole, capacity):
            pieces.append((document, start, capacity, sequences, 0))
            sequences += 1
        if length > whole:
            rest.append((length - whole, document, whole))
    total = sum(length for length, _, _ in rest)
    tail = total % capacity
    room = np.array([capacity] * (total // capacity) + [1 << bit for bit in reversed(range(tail.bit_length())) if tail >> bit & 1], np.int64)
    sizes, spent = room.copy(), np.zeros(len(room))

    def place(sequence, document, start, length):
        pieces.append((document, start, length, sequences + sequence, int(sizes[sequence] - room[sequence])))
        room[sequence] -= length
        spent[sequence] += cost(length)

    homeless = []
    for length, document, start in sorted(rest, key=lambda piece: (-piece[0], piece[1])):
        sequence = int(np.argmin(np.where(room >= length, spent, np.inf)))
        if room[sequence] >= length:
            place(sequence, document, start, length)
        else:
            homeless.append((length, document, start))
    for length, document, start in homeless:
        while length:
            sequence = int(np.argmin(np.where(room > 0, spent, np.inf)))
            part = int(min(length, room[sequence]))
            place(sequence, document, start, part)
            start, length = start + part, length - part
    return pieces


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_token: int = END_TOKEN,
    chunk_tokens: int = CHUNK_TOKENS,
) -> DataFrame:
    """One row for each piece of a document: where it starts, what it holds, and where it went."""
    end = np.array([end_token], "<u4").tobytes()
    schema = pa.schema([(field.name, pa.int64()) for field in PIECES.fields])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(tokenizer)
        first = TaskContext.get().partitionId() << 40
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def packed() -> pa.RecordBatch:
            nonlocal first
            rows = []
            for document, start, length, sequence, offset in pack([len(ids) // 4 for _, ids in held], capacity):
                key, ids = held[document]
                checksum = zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)])
                rows.append((key, start, length, checksum, len(ids) // 4, first + sequence, offset))
            first = max(row[5] for row in rows) + 1
            return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)], schema=schema)

        for batch in slices(batches):
            for key, text in zip(batch.column("doc_id").to_pylist(), utf8(batch)):
                held.append((key, tokens.of(text) + end))
                size += len(held[-1][1]) // 4
                if size >= chunk_tokens:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tasks, PIECES)
