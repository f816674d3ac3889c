"""Removal of repeated passages: hashes of fixed windows, in place of prefix-partitioned suffix trees.

No tree is built. The method dealt was one suffix subtree for each prefix group; here every window of
`WINDOW` words, the suffix that starts there cut at that depth, is one hash. A passage is removed if
`WINDOW` words of it stand earlier, and longer repeats are made of such windows, so the nodes of that one
depth decide all; and a hash of 8 bytes is moved and sorted instead of 20 words. Nodes of other depths,
common prefixes of neighbours and maximal repeats are not available, words of equal hashes are not
compared, and the prefixes below only deal windows out; they take no part in finding repeats.

Windows are split into groups by prefixes of variable length. A count of
all first and second words (as 10 and 6 bits of their hashes) finds the sizes; a run of first words
makes a group while it is small enough, a frequent first word is split by its second words, and a
frequent pair by ranges of the suffix's label, so that a group holds about `GROUP` suffixes whatever
the corpus. In a group a suffix is its label, a 64-bit hash of its words, and its place. Sorted
labels are in the order of the hash, not in suffix order; a run of equal labels holds what the tree
has under one node of that depth: its leaves are the occurrences, and all but the first one, by doc_id
and start, are repeats.

Suffixes are combined before the shuffle: a task sends each node of a block of `BLOCK` words once, with
its first leaf there, and knows the block's other leaves as repeats. So a passage in a third of all
documents sends one row for each block. Labels travel sorted, as differences, with places in as few
bytes as the block needs. Repeats return grouped by document, and cover their windows' words.

Two different windows of one group are confused with probability 2**-64 a pair: 3e-6 windows expected
in 0.5 GB, 2e-4 in 30 GB.

Null and empty texts have no words: n_words 0, and the digest of the empty text. Null doc_ids come first.
Different texts under one doc_id (or under none) are documents of their own, in order of a hash of the
text; equal rows are copies of one document and get equal results. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefare.llm.common import RunHashes, Words, few, groups, identified, mixed, shuffle_partitions, slices, stored, utf8, window_hashes

WINDOW = 20
#: Words in a task's block, and suffixes in a group.
BLOCK = 2_000_000
GROUP, LEAST_GROUP = 1_000_000, 20_000
FIRST_BITS, SECOND_BITS = 10, 6
CELLS = 1 << (FIRST_BITS + SECOND_BITS)
#: A slice of this many bytes is hashed at once (one longer text stands alone).
HASHED_BYTES = 1 << 20
#: Ids of at most so many documents with repeats, 8 bytes each, are broadcast.
BROADCAST_IDS = 1_000_000

RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_sha256", T.StringType()),
])


def suffixes(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(label, prefix cell, text, start) of every window that lies within one text."""
    counts = words.counts
    starts = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], counts)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(starts <= np.repeat(counts, counts) - window)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64), at, at
    codes = mixed(words.hashes)
    second = codes[np.minimum(at + 1, len(codes) - 1)] >> np.uint64(64 - SECOND_BITS)
    cells = ((codes[at] >> np.uint64(64 - FIRST_BITS)) << np.uint64(SECOND_BITS)) | second
    return window_hashes(words.hashes, window)[at], cells.astype(np.int64), text[at], starts[at]


def prefix_counts(docs: DataFrame, window: int) -> np.ndarray:
    """How many suffixes begin with each pair of word codes; the table has a fixed number of cells."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, total = RunHashes(), np.zeros(CELLS, np.int64)
        for batch in slices(batches, most_bytes=HASHED_BYTES):
            words = Words(utf8(batch), runs)
            total += np.bincount(suffixes(words, window)[1], minlength=CELLS)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    counts = np.zeros(CELLS, np.int64)
    found = docs.select("text").mapInArrow(tasks, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def prefix_groups(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each cell its group, and for each group into how many label ranges it is split."""
    by_first = counts.reshape(1 << FIRST_BITS, 1 << SECOND_BITS)
    group_of = np.zeros(by_first.shape, np.int64)
    splits: list[int] = []
    held = most + 1  # suffixes in the current group

    def place(where, size: int) -> None:
        nonlocal held
        if held + size > most:
            splits.append(max(1, -(-size // most)))
            held = 0
        group_of[where] = len(splits) - 1
        held += size

    for first, total in enumerate(by_first.sum(axis=1).tolist()):
        if total <= most:
            place(first, total)
        else:
            for second, size in enumerate(by_first[first].tolist()):
                place((first, second), size)
    return group_of.reshape(-1), np.array(splits or [1], np.int64)


def narrow(values: np.ndarray) -> tuple[int, bytes]:
    """Unsigned 64-bit numbers in as few bytes each as the largest needs."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return width, values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def widen(data: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(n, width)
    return out.view("<u8").reshape(-1)


def by_bucket(doc: np.ndarray, start: np.ndarray, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """(bucket of documents, n, n docs and n starts as bytes) from unordered pairs."""
    bucket = (mixed(doc.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, doc, start = bucket[order], doc[order].astype("<i8"), start[order].astype("<i4")
    cuts = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)].tolist()
    for low, high in zip(cuts[:-1], cuts[1:]):
        if high > low:
            yield int(bucket[low]), high - low, doc[low:high].tobytes() + start[low:high].tobytes()


def later_leaves(label: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first leaves, repeats) as positions; input sorted by label, then doc and start. A place that is there twice is no repeat."""
    new = np.r_[True, label[1:] != label[:-1]]
    head = np.maximum.accumulate(np.where(new, np.arange(len(label)), 0))
    return np.flatnonzero(new), np.flatnonzero(~new & ((doc != doc[head]) | (start != start[head])))


SENT = "grp int, least long, n int, widths array<int>, payload binary"
SENT_SCHEMA = pa.schema([("grp", pa.int32()), ("least", pa.int64()), ("n", pa.int32()), ("widths", pa.list_(pa.int32())), ("payload", pa.binary())])


def sent_blocks(docs: DataFrame, group_of: np.ndarray, splits: np.ndarray, window: int, block: int, buckets: int) -> DataFrame:
    """Rows for the groups and, with numbers below 0, the repeats that a block finds itself."""
    first_part = np.cumsum(splits) - splits
    shared = docs.sparkSession.sparkContext.broadcast((group_of.astype(np.int32), splits, first_part))

    def encoded(parts: list[tuple]) -> Iterator[tuple]:
        label, part, doc, start = (np.concatenate(column) for column in zip(*parts))
        if (doc[1:] < doc[:-1]).any():
            order = np.argsort(doc, kind="stable")
            label, part, doc, start = label[order], part[order], doc[order], start[order]
        order = np.argsort(label, kind="stable")
        label, part, doc, start = label[order], part[order], doc[order], start[order]
        heads, repeats = later_leaves(label, doc, start)
        for bucket, n, payload in by_bucket(doc[repeats], start[repeats], buckets):
            yield -1 - bucket, None, n, None, payload
        label, part, doc, start = label[heads], part[heads], doc[heads], start[heads]
        order = np.argsort(part, kind="stable")
        label, part, doc, start = label[order], part[order], doc[order], start[order]
        cuts = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)].tolist()
        for low, high in zip(cuts[:-1], cuts[1:]):
            if high > low:
                own, least = label[low:high], int(doc[low:high].min())
                steps = np.r_[own[:1], own[1:] - own[:-1]]
                coded = [narrow(steps), narrow((doc[low:high] - least).astype(np.uint64)), narrow(start[low:high].astype(np.uint64))]
                yield int(part[low]), least, high - low, [width for width, _ in coded], b"".join(data for _, data in coded)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell_group, split, first = shared.value
        runs, parts, size = RunHashes(), [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            rows = []
            for row in encoded(parts):
                rows.append(row)
                if len(rows) == 500:
                    yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), SENT_SCHEMA)], schema=SENT_SCHEMA)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), SENT_SCHEMA)], schema=SENT_SCHEMA)

        for batch in slices(batches, most_bytes=HASHED_BYTES):
            keys = batch.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
            label, cell, text, start = suffixes(Words(utf8(batch), runs), window)
            if not len(label):
                continue
            group = cell_group[cell]
            # A split group is cut by the upper bits of the label.
            part = first[group] + (((label >> np.uint64(32)) * split[group].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            parts.append((label, part.astype(np.int32), keys[text], start.astype(np.int32)))
            size += len(label)
            if size >= block:
                yield from flushed()
                parts, size = [], 0
        if parts:
            yield from flushed()

    return docs.select("doc", "text").mapInArrow(tasks, SENT)


def found_repeats(sent: DataFrame, buckets: int) -> DataFrame:
    """(doc, repeats): where windows that stand earlier elsewhere start, once for each document that has any."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (group,), columns in groups(batches, ["grp"]):
            if group < 0:
                rows = [(-1 - group, n, payload) for n, payload in zip(columns["n"], columns["payload"])]
            else:
                labels, docs, starts = [], [], []
                for least, n, widths, payload in zip(columns["least"], columns["n"], columns["widths"], columns["payload"]):
                    data, at = memoryview(payload), 0
                    decoded = []
                    for width in widths:
                        decoded.append(widen(data[at:at + n * width], n, width))
                        at += n * width
                    labels.append(np.cumsum(decoded[0], dtype=np.uint64))
                    docs.append(decoded[1].astype(np.int64) + least)
                    starts.append(decoded[2].astype(np.int64))
                label, doc, start = map(np.concatenate, (labels, docs, starts))
                order = np.argsort(label)
                ordered = label[order]
                same = ordered[1:] == ordered[:-1]
                order = order[np.r_[False, same] | np.r_[same, False]]
                order = order[np.lexsort((start[order], doc[order], label[order]))]
                _, repeats = later_leaves(label[order], doc[order], start[order]) if len(order) else (order, order)
                rows = list(by_bucket(doc[order[repeats]], start[order[repeats]], buckets))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))], names=["bucket", "n", "payload"]
                )

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, columns in groups(batches, ["bucket"]):
            pairs = [(np.frombuffer(data, "<i8", n), np.frombuffer(data, "<i4", n, 8 * n)) for n, data in zip(columns["n"], columns["payload"])]
            doc, start = map(np.concatenate, zip(*pairs))
            order = np.argsort(doc, kind="stable")
            doc, start = doc[order], start[order]
            cuts = np.r_[0, np.flatnonzero(doc[1:] != doc[:-1]) + 1, len(doc)].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[cuts[:-1]]), pa.array([start[low:high].tobytes() for low, high in zip(cuts[:-1], cuts[1:])], pa.binary())], names=["doc", "repeats"]
            )

    packed = sent.repartition("grp").sortWithinPartitions("grp").mapInArrow(tasks, "bucket int, n int, payload binary")
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(gathered, "doc long, repeats binary")


def without_repeats(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 from rows of (doc_id, text, repeats)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for key, text, repeats in zip(batch.column("doc_id").to_pylist(), utf8(batch), batch.column("repeats").to_pylist()):
                words, kept = kept_words(text, repeats, window)
                rows.append((key, words, words - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)

    return docs.select("doc_id", "text", "repeats").mapInArrow(tasks, RESULT)


def kept_words(text: bytes, repeats: bytes | None, window: int = WINDOW) -> tuple[int, list[bytes]]:
    """The number of words, and those that no repeated window covers."""
    words = text.split()
    if not repeats:
        return len(words), words
    change = np.zeros(len(words) + 1, np.int64)
    starts = np.unique(np.frombuffer(repeats, "<i4"))
    change[starts] += 1
    np.add.at(change, starts + window, -1)
    covered = np.cumsum(change[:-1]) > 0
    return len(words), [word for word, gone in zip(words, covered.tolist()) if not gone]


def repeated_windows(docs: DataFrame, window: int = WINDOW, block: int = BLOCK, most: int | None = None) -> DataFrame:
    """(doc, repeats): for each document with repeats, where they start, as 32-bit numbers; a stored table. `doc` as in `common.identified`."""
    return _repeated_windows(identified(docs), window, block, most)


def _repeated_windows(named: DataFrame, window: int, block: int, most: int | None) -> DataFrame:
    counts = prefix_counts(named, window)
    parts = shuffle_partitions(named.sparkSession)
    if most is None:
        most = int(min(GROUP, max(LEAST_GROUP, counts.sum() // (3 * parts))))
    # A bucket gathers the repeats of some documents: no more of them than a group has suffixes.
    buckets = max(parts, int(counts.sum() // GROUP))
    sent = sent_blocks(named, *prefix_groups(counts, most), window, block, buckets)
    return stored(found_repeats(sent, buckets), "suffix-repeats")


def remove_repeats(docs: DataFrame, window: int = WINDOW, block: int = BLOCK, most: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    named = identified(docs)
    found = _repeated_windows(named, window, block, most)
    if not few(found, BROADCAST_IDS):
        return without_repeats(named.join(found, "doc", "left"), window)
    # Only texts that change are shuffled.
    ids = F.broadcast(found.select("doc"))
    changed = named.join(ids, "doc", "left_semi").join(found.hint("shuffle_merge"), "doc")
    same = named.join(ids, "doc", "left_anti").withColumn("repeats", F.lit(None).cast("binary"))
    return without_repeats(changed, window).unionByName(without_repeats(same, window))
