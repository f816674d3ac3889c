"""Lempel-Ziv phrase fingerprints.

A text is parsed as LZ78 does: the next phrase is the shortest run of characters from here that is
not yet a phrase. Texts that compress each other share phrases. The phrases' hashes, as a set, are
kept as the `SIZE` smallest; the likeness of two texts is the Jaccard similarity of their phrase sets
estimated from the smallest hashes of both (exact where the sets together have no more than `SIZE`).

Every text is also compared with the text of the next doc_id and with an edit of its own: its last
half replaced by the beginning of the next text. Documents are dealt into ranges of doc_id, one
shuffle of the texts; the first document of each range also goes to the range before it, and the
very first one to the last. Within a range a task walks along the sorted rows and holds two texts. The
parse of the half that an edit keeps is shared by both parses.

Null texts count as empty; an empty text has no phrases, its fingerprint is the empty string, and it
is like another empty text (1) and unlike any other (0). The last run of a text is no new phrase if it
is already one. Null doc_ids come first; rows with equal doc_ids are ordered by text and each gives a
row. A single row is its own next. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefare.llm.common import RunHashes, shuffle_partitions, slices

SIZE = 128

FINGERPRINTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
])


def parse(text: str, at: int, known: set[str], ends: list[int]) -> int:
    """Adds the phrases of text[at:] to `known` and their ends to `ends`; returns where the unfinished last run starts.

    Known phrases are closed under prefixes, so the search for a phrase may start at the last one's length.
    """
    n, length = len(text), 1
    add, append = known.add, ends.append
    while at < n:
        end = at + length
        if end > n:
            length = n - at
            end = n
        piece = text[at:end]
        if piece in known:
            while piece in known:
                end += 1
                if end > n:
                    return at
                piece = text[at:end]
        else:
            shorter = piece[:-1]
            while shorter and shorter not in known:
                piece = shorter
                shorter = piece[:-1]
            end = at + len(piece)
        add(piece)
        append(end)
        length = end - at
        at = end
    return at


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def smallest(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The smallest distinct 32-bit values, ascending."""
    values = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(values) > 8 * size:
        values = np.partition(values, 4 * size)[:4 * size + 1]  # room for repetitions
    return np.unique(values)[:size]


def likeness(one: np.ndarray, other: np.ndarray, size: int = SIZE) -> float:
    if not len(one) and not len(other):
        return 1.0
    together = np.union1d(one, other)[:size]
    both = np.intersect1d(one, other, assume_unique=True)
    return float(np.isin(together, both, assume_unique=True).sum() / len(together))


def written(values: np.ndarray) -> str:
    return base64.urlsafe_b64encode(values.astype(">u4").tobytes()).decode()


class Walker:
    """Fingerprints of texts and of their edits, one text after the other."""

    def __init__(self, size: int = SIZE):
        self.size, self.runs = size, RunHashes()

    def hashed(self, text: str, ends: list[int]) -> np.ndarray:
        stops = np.array(ends, np.int64)
        return self.runs.of(code_points(text), np.r_[0, stops[:-1]] if len(stops) else stops, stops)

    def whole(self, text: str) -> np.ndarray:
        ends: list[int] = []
        parse(text, 0, set(), ends)
        return smallest(self.hashed(text, ends), self.size)

    def with_edit(self, text: str, following: str) -> tuple[np.ndarray, str, np.ndarray]:
        """The text's signature, its edit, and the edit's signature."""
        half = len(text) // 2
        kept = text[:len(text) - half]
        edited = kept + following[:half]
        known: set[str] = set()
        ends: list[int] = []
        at = parse(kept, 0, known, ends)
        known_then, ends_then = known.copy(), ends.copy()
        parse(text, at, known, ends)
        hashes = self.hashed(text, ends)
        shared = len(ends_then)
        parse(edited, at, known_then, ends_then)
        stops = np.array(ends_then[shared:], np.int64)
        rest = self.runs.of(code_points(edited), np.r_[at, stops[:-1]] if len(stops) else stops, stops)
        return smallest(hashes, self.size), edited, smallest(np.concatenate([hashes[:shared], rest]), self.size)


def range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds lie below doc_id, by bisection; 0 for null."""
    steps = [1 << bit for bit in reversed(range(max(1, len(bounds)).bit_length()))]
    padded = bounds + [(1 << 63) - 1] * (2 * steps[0] - 1 - len(bounds))
    listed = F.lit(padded)
    found = F.aggregate(
        F.lit(steps), F.lit(0),
        lambda below, step: F.when(F.element_at(listed, below + step) < doc_id, below + step).otherwise(below),
    )
    return F.coalesce(found, F.lit(0))


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """(range, ahead, doc_id, text): the documents, and once more, marked `ahead`, the first of each range for the range before."""
    parts = shuffle_partitions(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("long"))
    cuts = [k / parts for k in range(1, parts)]
    bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", cuts, 10_000)).first()[0] or [])) if cuts else []
    own = range_of(F.col("doc_id"), bounds)
    firsts = (
        ids.groupBy(own.alias("range")).agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id")).alias("first"))
        .orderBy("range").collect()  # one row for each range
    )
    before = {row["range"]: firsts[k - 1]["range"] for k, row in enumerate(firsts)}
    placed = docs.select(F.col("doc_id").cast("long"), "text").withColumn("range", own)
    is_first = F.lit(False)
    target = F.lit(None).cast("int")
    if firsts:
        listed = {row["range"]: row["first"]["doc_id"] for row in firsts}
        size = max(listed) + 1
        first_ids = F.lit([listed.get(k) if listed.get(k) is not None else -(1 << 63) for k in range(size)])
        targets = F.lit([before.get(k, 0) for k in range(size)])
        at = F.col("range") + 1
        is_first = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))) == F.element_at(first_ids, at)
        target = F.element_at(targets, at)
    copies = F.array(
        F.struct(F.col("range").alias("to"), F.lit(False).alias("ahead")),
        F.when(is_first, F.struct(target.alias("to"), F.lit(True).alias("ahead"))),
    )
    rows = placed.withColumn("copy", F.explode(F.array_compact(copies)))
    return rows.select(F.col("copy.to").alias("range"), F.col("copy.ahead").alias("ahead"), "doc_id", "text"), parts


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Fingerprints and likenesses of every document, its edit and the next document."""
    rows, parts = with_next(docs)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    schema = pa.schema(list(zip(FINGERPRINTS.names, kinds)))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker(size)
        # The text that waits for its next one, and the row that waits for the next one's signature.
        held: tuple[int | None, str] | None = None
        waiting: tuple | None = None
        ended = False
        for batch in slices(batches):
            out = []
            for ahead, key, text in zip(*(batch.column(name).to_pylist() for name in ("ahead", "doc_id", "text"))):
                if ended:
                    break
                text = text or ""
                if held is not None:
                    signature, edited, edited_signature = walker.with_edit(held[1], text)
                    if waiting:
                        out.append((*waiting[0], likeness(waiting[1], signature, size)))
                    row = (
                        held[0], len(held[1]), hashlib.sha256(edited.encode()).hexdigest(), written(signature),
                        written(edited_signature), likeness(signature, edited_signature, size),
                    )
                    waiting = (row, signature)
                held = (key, text)
                if ahead:
                    if waiting:
                        out.append((*waiting[0], likeness(waiting[1], walker.whole(text), size)))
                    ended = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], schema=schema)

    return (
        rows.repartitionById(parts, "range")
        .sortWithinPartitions("ahead", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
        .select("ahead", "doc_id", "text").mapInArrow(tasks, FINGERPRINTS)
    )
