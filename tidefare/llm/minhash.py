"""Near-duplicate documents by circulant MinHash, banding, and exact confirmation.

A document's set holds its distinct runs of `width` words. One permutation scatters the shingles over a
circle; a second one, turned by k places, gives coordinate k of the signature. `ROWS` coordinates make
a band; documents that share a band are candidates. At a similarity of 0.8 a pair shares none of the
`BANDS` bands with probability 4e-7.

1. Equal sets are one class; its smallest doc_id stands for it from here on.
2. In every bucket (equal bands) each document is compared with the smallest one, on full sets. A
   bucket sends one row for each member, never its pairs. Links join components.
3. Buckets that still hold several components may hide links between other members. They are split
   into blocks of at most `BLOCK` documents, and every two blocks meet in one task. Pairs of different
   components that have similar sizes and at least `LEAST_EQUAL` equal coordinates, and share no earlier
   band, are confirmed on full sets there; only links leave the task. (A pair at 0.8 has fewer equal
   coordinates with probability 3e-7.)
4. Components are joined again, and every document takes the one of its class.

Words are lower-cased in ASCII. Null and empty texts have an empty set, belong to no class and are
their own component; so is a null doc_id, whose component is null and which is kept. Rows that repeat
a doc_id are one node, so what links one of them links all, and all are kept if their doc_id is the
component's. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefare.llm.common import RunHashes, Words, groups, joined, mixed, odd_multipliers, slices, stored, utf8, window_hashes
from tidefare.llm.components import connected_components

SHINGLE_WORDS = 5
PERCENT = 80
BANDS, ROWS = 28, 4
#: A slice of this many bytes is signed at once (one longer text stands alone).
SIGNED_BYTES = 1 << 20
#: Coordinates that a pair must share, of BANDS * ROWS, to be confirmed on full sets in the last step.
LEAST_EQUAL = 68
BLOCK, HUB_ROWS = 1000, 500
#: Tables of at most so many rows of a few numbers, about 50 bytes each, are broadcast.
BROADCAST_ROWS = 400_000

SIGNED = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("set_key", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
])
LIST = pa.list_(pa.int64())


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingles as ascending 64-bit hashes; a text of fewer words is one shingle."""
    if not len(hashes):
        return hashes
    return np.unique(window_hashes(hashes, min(width, len(hashes)), seed=min(width, len(hashes))))


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """A row of minimum hashes for each non-empty set.

    The first permutation scatters shingles over a circle of 2**32 places; the second one, turned by k
    places, gives coordinate k.
    """
    starts = np.cumsum([0, *map(len, sets[:-1])])
    scattered = (mixed(np.concatenate(sets)) >> np.uint64(32)).astype(np.uint32)
    result = np.empty((len(sets), coordinates), np.uint32)
    turned, shifted = np.empty_like(scattered), np.empty_like(scattered)
    for k in range(coordinates):
        # A bijective scramble of 32 bits.
        np.add(scattered, np.uint32(k), out=turned)
        np.right_shift(turned, 16, out=shifted)
        np.bitwise_xor(turned, shifted, out=turned)
        np.multiply(turned, np.uint32(0x7FEB352D), out=turned)
        np.right_shift(turned, 15, out=shifted)
        np.bitwise_xor(turned, shifted, out=turned)
        np.multiply(turned, np.uint32(0x846CA68B), out=turned)
        result[:, k] = np.minimum.reduceat(turned, starts)
    return result


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    factors = odd_multipliers(rows, 7)
    with np.errstate(over="ignore"):
        parts = mixed(signature.reshape(len(signature), bands, rows).astype(np.uint64) + factors) * factors
        return mixed(parts.sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).astype(np.int64)


def signed(docs: DataFrame, width: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, the size and digest of its shingle set, and its band hashes (null for an empty set)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", LIST)])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = RunHashes()
        for batch in slices(batches, most_bytes=SIGNED_BYTES):
            words = Words([text.lower() for text in utf8(batch)], runs)
            sets = [shingles(words.of(k), width) for k in range(batch.num_rows)]
            full = [own for own in sets if len(own)]
            found = iter(band_hashes(signatures(full, bands * rows), bands, rows).tolist() if full else ())
            keys = [hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None for own in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.binary()), pa.array([next(found) if key else None for key in keys], LIST)],
                schema=schema,
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tasks, SIGNED)


def as_numbers(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint64)


def similar(sizes: np.ndarray, size: int, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be similar enough."""
    return 100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size)


def linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(other) - both)


def candidate_sets(docs: DataFrame, candidates: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(node, n, signature, shingles) of the candidate documents; the arrays as bytes."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("signature", pa.binary()), ("shingles", pa.binary())])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = RunHashes()
        for batch in slices(batches, most_bytes=SIGNED_BYTES):
            words = Words([text.lower() for text in utf8(batch)], runs)
            sets = [shingles(words.of(k), width) for k in range(batch.num_rows)]
            full = [k for k, own in enumerate(sets) if len(own)]
            if full:
                signed_rows = signatures([sets[k] for k in full], bands * rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").take(pa.array(full)), pa.array([len(sets[k]) for k in full], pa.int64()),
                     pa.array([row.tobytes() for row in signed_rows], pa.binary()), pa.array([sets[k].tobytes() for k in full], pa.binary())],
                    schema=schema,
                )

    named = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    return stored(
        joined(named, candidates, "node", BROADCAST_ROWS).mapInArrow(tasks, "node long, n long, signature binary, shingles binary"), "minhash-sets"
    )


def hub_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between bucket members and the smallest member of their bucket."""
    pairs = members.where(F.col("node") != F.col("hub")).select("hub", "node").distinct()
    sized = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / HUB_ROWS).cast("int").alias("salts"))
    # A hub with many members goes to several tasks; each gets its own copy of the hub's set.
    as_members = pairs.join(sized, "hub").select("hub", F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt"), F.lit(1).alias("role"), "node")
    as_hubs = sized.select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("hub").alias("node"))
    wanted = stored(as_members.unionByName(as_hubs), "minhash-hubs")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in batches:
            found = []
            for at, role, node, value in zip(*(batch.column(name).to_pylist() for name in ("hub", "role", "node", "shingles"))):
                if role == 0:
                    hub, hub_set = at, as_numbers(value)
                elif at == hub and linked(hub_set, as_numbers(value), percent):
                    found.append((at, node))
            yield pa.RecordBatch.from_arrays([pa.array([pair[k] for pair in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return (
        joined(sets.select("node", "shingles"), wanted, "node", BROADCAST_ROWS)
        .repartition("hub", "salt").sortWithinPartitions("hub", "salt", "role")
        .select("hub", "role", "node", "shingles").mapInArrow(tasks, "a long, b long")
    )


BLOCK_KEYS = ["bucket", "one", "other"]


def block_rows(members: DataFrame, components: DataFrame) -> DataFrame:
    """(bucket, one, other, block, node, component) for buckets that hold several components: every two blocks of a bucket meet."""
    labelled = members.join(components, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed_buckets = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        .where(F.col("least") != F.col("most")).select("bucket", "blocks")
    )
    placed = labelled.join(mixed_buckets, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    with_others = placed.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return stored(
        with_others.select("bucket", F.least("block", "partner").alias("one"), F.greatest("block", "partner").alias("other"), "block", "node", "component"),
        "minhash-blocks",
    )


def promising(columns: dict[str, list], percent: int, bands: int, rows: int, least_equal: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, earlier rows) of a block pair that may be linked and meet in no earlier bucket."""
    coordinates = np.stack([np.frombuffer(value, np.uint32) for value in columns["signature"]])
    keys = band_hashes(coordinates, bands, rows)
    band = (keys == np.array(columns["bucket"])[:, None]).argmax(axis=1)
    sizes, component, block = (np.array(columns[name]) for name in ("n", "component", "block"))
    within = columns["one"][0] == columns["other"][0]
    for row in range(1, len(sizes)):
        fits = (component[:row] != component[row]) & similar(sizes[:row], sizes[row], percent)
        if not within:  # pairs inside a block belong to the block's own meeting
            fits &= block[:row] != block[row]
        near = np.flatnonzero(fits)
        near = near[(coordinates[near] == coordinates[row]).sum(axis=1) >= least_equal]
        if band[row] and len(near):
            near = near[~(keys[near, :band[row]] == keys[row, :band[row]]).any(axis=1)]
        if len(near):
            yield row, near


def cross_links(members: DataFrame, components: DataFrame, sets: DataFrame, percent: int, bands: int, rows: int, least_equal: int) -> DataFrame:
    """Links between members of different components that share a bucket."""
    meeting = block_rows(members, components)
    kinds = [("bucket", pa.int64()), ("one", pa.int32()), ("other", pa.int32()), ("block", pa.int32()), ("node", pa.int64()), ("component", pa.int64())]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, columns in groups(batches, BLOCK_KEYS):
            wanted: set[int] = set()
            for row, near in promising(columns, percent, bands, rows, least_equal):
                wanted.update((row, *near.tolist()))
            if wanted:
                order = sorted(wanted)
                yield pa.RecordBatch.from_arrays([pa.array([columns[name][k] for k in order], kind) for name, kind in kinds], schema=pa.schema(kinds))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, columns in groups(batches, BLOCK_KEYS):
            sets_here = [as_numbers(value) for value in columns["shingles"]]
            found = [
                (columns["node"][row], columns["node"][k])
                for row, near in promising(columns, percent, bands, rows, least_equal)
                for k in near.tolist() if linked(sets_here[row], sets_here[k], percent)
            ]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*found)], names=["a", "b"])

    def meet(rows_: DataFrame, *more: str) -> DataFrame:
        return joined(sets.select("node", "n", "signature", *more), rows_, "node", BROADCAST_ROWS).repartition(*BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS, "node")

    wanted = stored(
        meet(meeting).mapInArrow(find, "bucket long, one int, other int, block int, node long, component long"), "minhash-meetings"
    )
    return meet(wanted, "shingles").mapInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, least_equal: int = LEAST_EQUAL) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    sketches = stored(signed(docs, width, bands, rows), "minhash-signatures")
    classes = stored(sketches.where("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("node")), "minhash-classes")
    leaders = sketches.select("set_key", F.col("doc_id").alias("node"), "bands").join(classes, ["set_key", "node"])
    banded = leaders.select("node", F.explode("bands").alias("bucket")).distinct()
    shared = banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket", "hub")
    members = stored(banded.join(shared, "bucket"), "minhash-members")
    candidates = stored(members.select("node").distinct(), "minhash-candidates")
    sets = candidate_sets(docs, candidates, width, bands, rows)
    links = stored(hub_links(members, sets, percent), "minhash-links")
    components = connected_components(links)
    more = stored(cross_links(members, components, sets, percent, bands, rows, least_equal), "minhash-links")
    if not more.isEmpty():
        components = connected_components(links.unionByName(more))
    named = classes.join(components, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    return (
        sketches.drop("bands").join(named, "set_key", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def one_of_each(docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, without those that a document of smaller id stands for."""
    removed = stored(near_duplicates(docs, width, percent).where("NOT kept").select("doc_id"), "minhash-removed")
    return joined(docs, removed, "doc_id", BROADCAST_ROWS, "left_anti")
