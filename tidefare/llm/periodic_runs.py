"""Periodic runs of words, by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), of at least
`LEAST_WORDS` words and `LEAST_EXPONENT` periods, that no neighbouring word extends.

The basic factors are the stretches of L = 1, 2, 4, ... words. Each has a number, equal numbers standing
for equal words: first the words' own, exact, then for 2 L the rank of the pair of numbers at i and
i + L. For every L

1. each factor's next occurrence is found, one sort of the numbers. Two occurrences p apart that lie
   within 2 L words (p <= L) overlap or touch, and propose the period p;
2. consecutive positions with the same p make an arithmetic progression with step p; from the first
   position x to the last one y it *extends* to the words x to y + L + p, and no further: one more
   position would have been in the progression. As the next occurrence is nearer if the stretch has a
   smaller period, p is the smallest one;
3. only p > L / 2 is taken at L (p = 1 at L = 1), so no run is found twice. A run of four periods has
   a factor of every such length with a next occurrence.

Positions whose factor occurs once in its text leave, so that long factors cost little where little
repeats. Texts are handled in slices of bounded size (one longer text stands alone); memory is a few
numbers for each word at a time. No rows are shuffled.

Null and empty texts have no words, no runs and an empty collapsed text. Repeated rows and null doc_ids
give a row each. Columns other than the id and the text are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefare.llm.common import slices, utf8

LEAST_WORDS, LEAST_EXPONENT = 6, 4
#: A slice of this many bytes is searched at once.
SEARCHED_BYTES = 2 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, strongest struct<start: long, length: long, period: long>, collapsed string"
RUNS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("strongest", RUN), ("collapsed", pa.string())])


def coded(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers of all texts, where each text begins): after every text stands a number that occurs once."""
    known: dict[bytes, int] = {}
    codes: list[int] = []
    firsts = []
    for number, words in enumerate(texts):
        firsts.append(len(codes))
        codes.extend([known.setdefault(word, len(known)) for word in words])
        codes.append(-1 - number)
    return np.array(codes, np.int64), np.array(firsts, np.int64)


def progressions(position: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, step) of runs of consecutive positions with equal steps."""
    breaks = np.flatnonzero((position[1:] != position[:-1] + 1) | (step[1:] != step[:-1]))
    first, last = np.r_[0, breaks + 1], np.r_[breaks, len(position) - 1]
    return position[first], position[last], step[first]


def runs_of(codes: np.ndarray, text: np.ndarray, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) in order of start, then period. `text` numbers the text of each place; separators occur once."""
    found = [np.empty((0, 3), np.int64)]
    position = np.flatnonzero(codes >= 0)
    number = codes[position]
    longest = int(np.bincount(text).max(initial=0)) if len(text) else 0
    factor = 1
    while len(position) > 1 and factor <= max(1, longest // 2):
        order = np.argsort(number, kind="stable")
        at, sorted_number = position[order], number[order]
        same = (sorted_number[1:] == sorted_number[:-1]) & (text[at[1:]] == text[at[:-1]])
        distance = at[1:] - at[:-1]
        near = np.flatnonzero(same & (distance <= factor) & (2 * distance > factor))
        if len(near):
            by_place = near[np.argsort(at[near])]
            first, last, period = progressions(at[by_place], distance[by_place])
            length = last - first + factor + period
            enough = length >= np.maximum(least_words, least_exponent * period)
            found.append(np.stack([first, length, period], axis=1)[enough])
        # Only factors that repeat in their text can be halves of one that does.
        live = np.sort(order[np.r_[False, same] | np.r_[same, False]])
        position, number = position[live], number[live]
        following = np.searchsorted(position, position + factor)
        paired = following < len(position)
        paired[paired] = position[following[paired]] == position[paired] + factor
        left, right = number[paired], number[following[paired]]
        position = position[paired]
        if len(position):
            pair = left * (int(number.max()) + 1) + right
            number = np.unique(pair, return_inverse=True)[1]
        factor *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, exactly; the smallest start, then period, among equals."""
    best = None
    for run in runs:  # in order of start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return b" ".join([word for word, dropped in zip(words, gone.tolist()) if not dropped])


def text_runs(texts: list[list[bytes]], least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as words."""
    codes, firsts = coded(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(np.r_[firsts, len(codes)]))
    runs = runs_of(codes, text, least_words, least_exponent)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    owner = text[runs[:, 0]]
    for k, start, (_, length, period) in zip(owner.tolist(), (runs[:, 0] - firsts[owner]).tolist(), runs.tolist()):
        out[k].append((start, length, period))
    return out


def find_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """doc_id, n_words, the runs by start and period, the strongest one, and the text with each run cut to its first period."""

    def as_run(run: tuple[int, int, int]) -> dict[str, int]:
        return dict(zip(("start", "length", "period"), run))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_bytes=SEARCHED_BYTES):
            texts = [text.split() for text in utf8(batch)]
            found = text_runs(texts, least_words, least_exponent)
            best = [strongest(runs) for runs in found]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array(map(len, texts), pa.int64()),
                pa.array([[as_run(run) for run in runs] for runs in found], pa.list_(RUN)),
                pa.array([as_run(run) if run else None for run in best], RUN),
                pa.array([collapsed(words, runs) for words, runs in zip(texts, found)], pa.binary()).cast(pa.string()),
            ], schema=RUNS_SCHEMA)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tasks, RUNS)
