"""Repetition rules from suffix arrays over words.

The documents of a slice are joined into one sequence of word numbers; a word has another number in
each text, so no common prefix runs across texts. Prefix doubling ranks the
suffixes by their first 1, 2, 4, 8, ... words; from 8 words on only suffixes that still share their
rank with another are ranked again, and they are few. Neighbours in suffix order give longest common
prefixes, found by halving with hashes of runs, so that memory is some numbers a word however long the repeats: a run of neighbours that share at least `WINDOW` words is an interval whose common prefix is
a repeated substring. The union of the spans [start, start + longest common prefix) of all such
suffixes is what repeats; it equals the union of all windows of `WINDOW` words that occur twice.

A document passes the basic rule with at least 20 words of which at most 30 in 100 repeat. The
verdict also limits the fraction of the characters of words that repeats cover (`MOST_COVERED`) and the
longest repeat (`LONGEST_SHARE` of the words, at least `LONGEST_WORDS`).

Null texts count as empty: no words, failed. A text longer than a slice stands alone in one. Each input row gives one row, also if rows repeat; an
empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefare.llm.common import RunHashes, Words, slices, utf8

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
MOST_COVERED = 0.30
LONGEST_SHARE, LONGEST_WORDS = 0.15, 60
#: A slice of this many bytes is ordered at once (one longer text stands alone).
ORDERED_BYTES = 1 << 20
#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"

RULES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("longest_repeat", T.LongType()),
])


def shared_prefixes(numbers: np.ndarray, runs: RunHashes, window: int = WINDOW) -> np.ndarray:
    """For each position the longest prefix that its suffix shares with another suffix; 0 if under `window`."""
    n = len(numbers)
    longest = np.zeros(n, np.int32)
    if n == 0:
        return longest

    def ahead(rank: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
        inside = at + step < n
        return np.where(inside, rank[np.where(inside, at + step, 0)] + 1, 0)

    # Ranks by the first 1, 2, 4, ... words, equal exactly if those words are: all suffixes until `window`.
    rank, length, every = np.unique(numbers, return_inverse=True)[1].astype(np.int32), 1, np.arange(n, dtype=np.int32)
    while length < window:
        step = min(length, window - length)
        rank = np.unique(rank.astype(np.int64) * (n + 2) + ahead(rank, every, step), return_inverse=True)[1].astype(np.int32)
        length += step
    del every
    sizes = np.bincount(rank)
    repeated = live = np.flatnonzero(sizes[rank] > 1).astype(np.int32)
    if not len(live):
        return longest
    rank = (np.cumsum(sizes) - sizes)[rank].astype(np.int32)  # where the group of equal prefixes starts in suffix order
    # From there only suffixes that are not yet alone are ordered further, in place.
    while len(live):
        further = ahead(rank, live, length)
        order = np.lexsort((further, rank[live]))
        live, further = live[order], further[order]
        own = rank[live]
        new_group = np.r_[True, own[1:] != own[:-1]]
        new_part = new_group | np.r_[True, further[1:] != further[:-1]]
        place = np.arange(len(live), dtype=np.int32)
        rank[live] = own + np.maximum.accumulate(np.where(new_part, place, 0)) - np.maximum.accumulate(np.where(new_group, place, 0))
        part = np.cumsum(new_part) - 1
        live = live[np.bincount(part)[part] > 1]
        length *= 2
    # Suffix order of all that repeat. The common prefix of neighbours is at least a window if their first ones are
    # equal, and is found by halves of the longest, from hashes of runs.
    suffixes = repeated[np.argsort(rank[repeated])]
    del rank, repeated
    same, length = runs.equal(numbers), 1 << int(length).bit_length()
    left, right = suffixes[:-1], suffixes[1:]
    common = np.zeros(len(left), np.int32)
    while length:
        inside = np.maximum(left, right) + common + length <= n
        at = np.flatnonzero(inside)
        equal = at[same(left[at] + common[at], right[at] + common[at], length)]
        common[equal] += length
        length //= 2
    common[common < window] = 0
    longest[left] = common
    longest[right] = np.maximum(longest[right], common)
    return longest


def measured(texts: list[bytes], runs: RunHashes, window: int = WINDOW) -> list[tuple]:
    """(words, word characters, symbols, repeated lines, words in repeats, longest repeat, covered share of bytes) of each text."""
    words = Words(texts, runs)
    counts, ends = words.counts, words.first[1:]
    # A word has another number in each text, so no common prefix joins or crosses two texts.
    with np.errstate(over="ignore"):
        sequence = words.hashes + np.repeat(np.arange(len(texts), dtype=np.uint64), counts) * np.uint64(0xD1342543DE82EF95)
    longest = shared_prefixes(sequence, runs, window)
    opened = np.zeros(len(sequence) + 1, np.int32)
    starts = np.flatnonzero(longest)
    np.add.at(opened, starts, 1)
    np.add.at(opened, starts + longest[starts], -1)
    covered = np.cumsum(opened)[:-1] > 0
    sizes = words.ends - words.starts
    rows = []
    for k, (text, end) in enumerate(zip(texts, ends)):
        first = end - counts[k]
        plain = text.decode()
        lines = [line for line in text.split(b"\n") if line.strip()]
        rows.append((
            int(counts[k]),
            len(plain) - sum(map(text.count, (SPACE[i:i + 1] for i in range(len(SPACE))))),
            sum(map(text.count, (SYMBOLS[i:i + 1] for i in range(len(SYMBOLS))))),
            len(lines) - len(set(lines)),
            int(covered[first:end].sum()),
            int(longest[first:end].max(initial=0)),
            float(sizes[first:end][covered[first:end]].sum() / max(1, sizes[first:end].sum())),
        ))
    return rows


def repetition_rules(docs: DataFrame, window: int = WINDOW, most_covered: float = MOST_COVERED) -> DataFrame:
    """The measures and the verdict of every row."""
    names = [field.name for field in RULES.fields]
    kinds = [pa.bool_() if isinstance(field.dataType, T.BooleanType) else pa.int64() for field in RULES.fields]
    schema = pa.schema(list(zip(names, kinds)))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = RunHashes()
        for batch in slices(batches, most_bytes=ORDERED_BYTES):
            rows = []
            for key, found in zip(batch.column("doc_id").to_pylist(), measured(utf8(batch), runs, window)):
                words, _, _, _, repeated, longest, share = found
                failed = words < LEAST_WORDS or 100 * repeated > MOST_REPEATED_PERCENT * words
                kept = not failed and share <= most_covered and longest <= max(LONGEST_WORDS, LONGEST_SHARE * words)
                rows.append((key, *found[:5], failed, kept, longest))
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tasks, RULES)
