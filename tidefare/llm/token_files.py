"""Token ids of a corpus in compressed, checksummed blocks, in order of doc_id.

Writing: documents are dealt into ranges of (doc_id, text) of about equal numbers of rows, one shuffle of the texts;
each range is sorted, tokenized and written as one *part*. A part's ids, an end id after each document,
form one stream that is cut into blocks of `id_coder.BLOCK_IDS` ids; each block is coded on its own by the
adaptive context-mixing range coder and carries its length and checksum. A token table is a
Parquet folder with a row for each block:

    part int, block int, first long (ids before it in the part), n_ids int, data binary,
    doc_ids array<long>, begins array<int>   (documents that begin in the block, and where)

It is written by Spark's committed writer, so a lost or repeated task leaves no half or double part.

Reading: blocks are dealt by part and sorted; a task decodes them `LANES` at a time, compares every checksum
and cuts the stream at the documents' beginnings. A block that fails raises `Damaged`; blocks missing in a
part or parts that lack their first block raise it too.

A task holds the ids of `LANES` blocks, or of one document if that is longer. The number of ranges is
that of shuffle partitions, fewer if one would get less than `LEAST_PART_BYTES` of text, more if it would get over `PART_BYTES`.

Null and empty texts have the end id only. Null doc_ids come first. Rows of one doc_id are ordered by a
hash of their text, then the text, so they may be dealt to several ranges; equal rows are written as often
as they occur. An empty table gives no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidefare.llm.byte_tokens import ByteTokens
from tidefare.llm.common import shuffle_partitions, slices
from tidefare.llm.id_coder import BLOCK_IDS, LANES, Damaged, decode, encode

END_ID = 0
#: A part holds at least so much text, if there are partitions to spare, and at most so much.
LEAST_PART_BYTES, PART_BYTES = 8 << 20, 128 << 20

BLOCKS = "part int, block int, first long, n_ids int, data binary, doc_ids array<long>, begins array<int>"
BLOCKS_SCHEMA = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("data", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("begins", pa.list_(pa.int32())),
])


def table_columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def in_order(docs: DataFrame) -> DataFrame:
    """(part, doc_id, text): ranges of rows by doc_id, each sorted; parts follow each other."""
    named = docs.select(F.col("doc_id").cast("long"), "text").withColumn("tie", F.xxhash64("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, min(shuffle_partitions(docs.sparkSession), -(-size // LEAST_PART_BYTES)), -(-size // PART_BYTES))
    by: list[Column] = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    return (
        named.repartitionByRange(parts, *by).sortWithinPartitions(*by, F.col("text").asc_nulls_first())
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )


def write_token_table(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Writes the token table of the documents to a new folder."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens(tokenizer)
        ids_in_all = max(tokens.tokenizer.get_vocab_size(), end_id + 1)
        end = np.array([end_id], "<u4").tobytes()
        held: list[bytes] = []
        begins: list[tuple[int, int | None]] = []  # place in the part's stream, doc_id
        part = block = through = size = 0  # `through` ids are written, `size` ids are held

        def written(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, begins, block, through, size
            stream = np.frombuffer(b"".join(held), "<u4")
            ready = len(stream) if last else len(stream) // BLOCK_IDS * BLOCK_IDS
            for start in range(0, ready, LANES * BLOCK_IDS):
                group = stream[start:min(ready, start + LANES * BLOCK_IDS)]
                rows, at = [], 0
                for data in encode(group, ids_in_all):
                    n = min(BLOCK_IDS, len(group) - len(rows) * BLOCK_IDS)
                    stop = at
                    while stop < len(begins) and begins[stop][0] < through + n:
                        stop += 1
                    own = begins[at:stop]
                    rows.append((part, block, through, n, data, [key for _, key in own], [place - through for place, _ in own]))
                    at, block, through = stop, block + 1, through + n
                begins = begins[at:]
                yield table_columns(rows, BLOCKS_SCHEMA)
            held, size = [stream[ready:].tobytes()], len(stream) - ready

        for batch in slices(batches):
            part = batch.column("part")[0].as_py()
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                begins.append((through + size, key))
                held.append(tokens.of(text or "") + end)
                size += len(held[-1]) // 4
                if size >= LANES * BLOCK_IDS:
                    yield from written(False)
        if size:
            yield from written(True)

    in_order(docs).mapInArrow(tasks, BLOCKS).write.parquet(path)


def part_offsets(blocks: DataFrame) -> DataFrame:
    """(part, before): how many ids stand in the parts before; the table of parts, a row each, passes through one task."""
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))


READ = "part int, doc_id long, place long, ids binary"
READ_SCHEMA = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("place", pa.int64()), ("ids", pa.binary())])


def read_token_table(spark: SparkSession, path: str, ids_in_all: int) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian unsigned 32 bit, with the end id) of every document."""
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The document that is not yet whole, and what there is of it.
        part, following, place = None, 0, 0
        open_doc: tuple[int | None, int] | None = None
        pieces: list[bytes] = []

        def closed() -> list[tuple]:
            return [(part, open_doc[0], open_doc[1], b"".join(pieces))] if open_doc else []

        def documents(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            nonlocal part, following, place, open_doc, pieces
            out = []
            for row, ids in zip(rows, decode([row["data"] for row in rows], ids_in_all)):
                if row["part"] != part:
                    out += closed()
                    part, following, place, open_doc, pieces = row["part"], 0, 0, None, []
                if (row["block"], row["first"], row["n_ids"]) != (following, place, len(ids)) or (open_doc is None and row["begins"][:1] != [0]):
                    raise Damaged(f"part {row['part']} lacks block {following}")
                data, at = ids.tobytes(), 0
                for key, begin in zip(row["doc_ids"], row["begins"]):
                    pieces.append(data[4 * at:4 * begin])
                    out += closed()
                    open_doc, pieces, at = (key, place + begin), [], begin
                pieces.append(data[4 * at:])
                following, place = following + 1, place + len(ids)
            if out:
                yield table_columns(out, READ_SCHEMA)

        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == LANES:
                    yield from documents(held)
                    held = []
        if held:
            yield from documents(held)
        if open_doc:
            yield table_columns(closed(), READ_SCHEMA)

    parts = max(1, (blocks.agg(F.max("part")).first()[0] or 0) + 1)
    found = blocks.repartitionById(parts, "part").sortWithinPartitions("part", "block").mapInArrow(tasks, READ)
    # One row a part; its size grows by one for `PART_BYTES` of text.
    return found.join(F.broadcast(part_offsets(blocks)), "part").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "ids")
