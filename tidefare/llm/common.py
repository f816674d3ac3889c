"""Helpers shared by the text operators: batches inside tasks, word hashes, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefare.session import scratch_path

#: White space that separates words; every other character belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts handled together inside a task: at most so many rows, or so many bytes (one longer text stands alone).
SLICE_ROWS, SLICE_BYTES = 2_000, 4 << 20
#: Distinct words a task remembers before it forgets them all.
CACHED_WORDS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared scratch folder and read back: later steps neither
    recompute them nor depend on an executor's disk."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: Stands for a null doc_id, before all others.
NO_ID = -(1 << 63)


def identified(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """(doc, doc_id, text, and `row` if given): `doc` is a number in order of doc_id, nulls first, that tells rows apart.

    Where every doc_id has one text, `doc` is the doc_id. Else rows of one doc_id are in order of a hash of
    their text; their numbers come from a sorted, stored table of (doc_id, hash). Equal rows share a number: they are
    copies of one document.
    """
    columns = [F.col("doc_id").cast("long").alias("doc_id"), "text"] + ([row.alias("row")] if row is not None else [])
    named = docs.select(*columns)
    doc_id = F.coalesce("doc_id", F.lit(NO_ID))
    plain = named.withColumn("doc", doc_id)
    # Texts are only read if an id occurs twice.
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        return plain
    hashed = plain.withColumn("tie", F.xxhash64("text"))
    if hashed.groupBy("doc").agg(F.min("tie").alias("least"), F.max("tie").alias("most")).where("least <> most").isEmpty():
        return plain
    numbers = hashed.select("doc", "tie").distinct().repartitionByRange("doc", "tie").sortWithinPartitions("doc", "tie")
    numbered = stored(numbers.withColumn("number", F.monotonically_increasing_id()), "row-numbers")
    return hashed.join(numbered, ["doc", "tie"]).drop("doc", "tie").withColumnRenamed("number", "doc")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder_of_crc(column: str, modulus: int) -> Column:
    """crc32 of the value written as text, modulo; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each part holds a bounded number of rows and bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and (held + size > most_bytes or row - start >= SLICE_ROWS):
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def utf8(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    column = batch.column(text)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers (fixed values: the splitmix64 constants)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def odd_multipliers(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit integers, equal in every run."""
    with np.errstate(over="ignore"):
        steps = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mixed(steps) | np.uint64(1)


class RunHashes:
    """Hashes of runs of numbers as differences of one running sum: polynomials modulo 2**64 in a fixed odd base."""

    def __init__(self, base: int = 0x9E3779B97F4A7C15):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.powers = self.inverses = np.empty(0, np.uint64)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        """Running sums of the values, each times its place's power of the base."""
        n = len(values)
        if len(self.powers) < n + 1:
            size = max(1 << 14, n + n // 4)
            with np.errstate(over="ignore"):
                self.powers = np.cumprod(np.r_[np.uint64(1), np.full(size, self.base, np.uint64)], dtype=np.uint64)
                self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(size, self.inverse, np.uint64)], dtype=np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((values.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        return sums

    def of(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = self._sums(values)
        with np.errstate(over="ignore"):
            return mixed((sums[ends] - sums[starts]) * self.inverses[starts])

    def equal(self, values: np.ndarray) -> Callable[[np.ndarray, np.ndarray, int], np.ndarray]:
        """Whether runs of a length that start at some places equal those at others, by their hashes."""
        sums = self._sums(values)

        def same(one: np.ndarray, other: np.ndarray, length: int) -> np.ndarray:
            with np.errstate(over="ignore"):
                return (sums[one + length] - sums[one]) * self.inverses[one] == (sums[other + length] - sums[other]) * self.inverses[other]

        return same


#: Marks the bytes that separate words: 9 to 13 and 32.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[*range(9, 14), 32]] = True


class Words:
    """The words of some texts: their hashes, their places in `buffer`, and where each text's words begin."""

    def __init__(self, texts: list[bytes], runs: RunHashes):
        self.buffer = b"\n" + b"\n".join(texts) + b"\n"
        data = np.frombuffer(self.buffer, np.uint8)
        space = IS_SPACE[data]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.starts, self.ends = edges[::2], edges[1::2]
        self.hashes = runs.of(data, self.starts, self.ends)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        text_starts = 1 + np.cumsum(sizes + 1) - sizes - 1
        self.first = np.r_[np.searchsorted(self.starts, text_starts), len(self.starts)]

    def of(self, text: int) -> np.ndarray:
        return self.hashes[self.first[text]:self.first[text + 1]]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def window_hashes(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """One hash for each run of `width` word hashes; the words' order counts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k, factor in enumerate(odd_multipliers(width, seed)):
            total += hashes[k:k + n] * factor
    return mixed(total)


def few(frame: DataFrame, most: int) -> bool:
    """Whether a stored table has at most so many rows."""
    return frame.count() <= most


def joined(rows: DataFrame, stored_rows: DataFrame, on: str | list[str] | Column, most: int, how: str = "inner") -> DataFrame:
    """`rows` joined with a stored table that is broadcast only if it is counted to have at most `most` rows."""
    return rows.join(F.broadcast(stored_rows) if few(stored_rows, most) else stored_rows, on, how)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Runs of rows with equal keys, as columns of values; the rows come sorted by the keys."""
    current: tuple | None = None
    held: dict[str, list] = {}
    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        names = list(zip(*(columns[name] for name in keys)))
        start = 0
        for row in range(1, len(names) + 1):
            if row == len(names) or names[row] != names[start]:
                if names[start] != current:
                    if held:
                        yield current, held
                    current, held = names[start], {name: [] for name in columns}
                for name, values in columns.items():
                    held[name].extend(values[start:row])
                start = row
    if held:
        yield current, held
