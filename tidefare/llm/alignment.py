"""Alignment of two tokenizers' tokens, composed from fragments.

A text with a space before it is encoded by a byte-level BPE tokenizer (A) and a sentence-piece model (B).
Byte offsets where a token of each ends are *common ends*; they cut both token streams into groups.
A *fragment* describes the tokens that end within a range of bytes: its open prefix (the tokens through
the range's first common end, whose group may have begun earlier), its closed groups, and its open suffix
(the tokens after the last common end). `compose` joins the fragments of adjacent ranges: the suffix of
the one and the prefix of the other make a closed group. It is associative, and the empty fragment is
neutral, so fragments may be joined in any grouping.

* In both tokenizers a token ends before a space that follows a non-space and precedes a non-space. The
  fragment of the bytes between two such places is closed on both sides, depends on those bytes alone, and
  is remembered: texts are chains of words.
* A text of more than `RANGE_BYTES` is cut into ranges of that size, wherever they fall. Each range goes to some task with
  the bytes to the nearest such places around it, and gives a fragment with open ends. Fragments are
  composed `FAN` at a time, a round of tasks for each level of the tree, until one is left.

A link is a pair of tokens, one of each side, whose bytes overlap: one for each stretch between
adjacent ends of any token. Pairs of ids are counted once for each document (row) that holds them linked, over the
whole corpus. The `BROADCAST_PAIRS` most frequent pairs are looked up from a broadcast table of that
bound; links of rarer pairs are shuffled, and as they are rare no pair is hot.

Null and empty texts have no tokens, and neither has a text whose tokens' bytes are not its own in A or
in B (U+2581 in the text does that): counts 0 and an empty `groups`. Special tokens' strings in texts are
plain text. Repeated rows and null doc_ids give a row each, and each row counts as a document. Columns other than the id and the
text are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefare.llm.byte_tokens import LONGEST_KEPT, ByteTokens, Unsplit, spaced_words
from tidefare.llm.common import CACHED_WORDS, groups, slices, stored

#: Texts of more bytes are cut into ranges of this size.
RANGE_BYTES = 64 << 10
#: Fragments that one step of the tree composes.
FAN = 16
#: Pairs of ids, with their counts, that are broadcast: 13 bytes each.
BROADCAST_PAIRS = 2_000_000
#: Distinct pairs of ids a task counts before it passes them on.
COUNTED_PAIRS = 4_000_000
#: Words of more tokens are aligned as arrays.
FEW_TOKENS = 64
#: Fixed value: how the sentence pieces show a space.
SHOWN_SPACE = "▁"

Tokens = tuple[np.ndarray, np.ndarray]  # ids, and where in the text they end
NO_TOKENS: Tokens = (np.empty(0, np.int64), np.empty(0, np.int64))


@dataclass(slots=True)
class Closed:
    """Whole groups: their tokens' numbers, their links as codes, and themselves as text `a1,a2|b1;a3|b2,b3`."""

    n_a: int = 0
    n_b: int = 0
    n: int = 0
    codes: bytes = b""
    text: str = ""

    def __add__(self, other: Closed) -> Closed:
        between = ";" if self.n and other.n else ""
        return Closed(self.n_a + other.n_a, self.n_b + other.n_b, self.n + other.n, self.codes + other.codes, self.text + between + other.text)


@dataclass
class Fragment:
    """The tokens that end within a range of bytes; without a common end (`cut`) all are in the prefix. Not `whole`: the bytes differ."""

    prefix: tuple[Tokens, Tokens] = (NO_TOKENS, NO_TOKENS)
    closed: Closed = field(default_factory=Closed)
    suffix: tuple[Tokens, Tokens] = (NO_TOKENS, NO_TOKENS)
    cut: bool = False
    whole: bool = True


def chained(one: tuple[Tokens, Tokens], other: tuple[Tokens, Tokens]) -> tuple[Tokens, Tokens]:
    return tuple(tuple(np.concatenate(pair) for pair in zip(*side)) for side in zip(one, other))


def numbers(values: np.ndarray) -> str:
    return ",".join(map(str, values.tolist()))


class Aligner:
    """Both tokenizers, the closed fragments of the words seen, and how pairs of ids are written as codes."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a = ByteTokens(byte_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        byte_of = {shown: byte for byte, shown in self.a.printable.items()}
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=False)
        self.a_bytes = {index: bytes(byte_of[c] for c in token) for token, index in vocabulary.items() if set(token) <= byte_of.keys()}
        self.pieces = [self._piece_bytes(k) for k in range(self.b.get_piece_size())]
        if any(SHOWN_SPACE in self.b.id_to_piece(k).lstrip(SHOWN_SPACE) for k in range(len(self.pieces))):
            raise ValueError(f"pieces reach over spaces: {piece_path}")
        self.b_ids = len(self.pieces)
        self.code_type = np.dtype("<u4" if (max(vocabulary.values()) + 1) * self.b_ids <= 1 << 32 else "<u8")
        self.names = list(map(str, range(max(max(vocabulary.values()) + 1, self.b_ids))))
        self.array_code = "I" if self.code_type.itemsize == 4 else "Q"
        self.known: dict[str, Closed | None] = {}

    def _piece_bytes(self, index: int) -> bytes:
        piece = self.b.id_to_piece(index)
        if self.b.is_byte(index):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SHOWN_SPACE, " ").encode()

    def ids(self, part: str) -> tuple[list[int], list[int]]:
        """Both tokenizers' ids of a part that begins with a space."""
        plain = len(part) > 1 and not part[1].isspace()
        return array("I", self.a.word(part[1:]) if plain else self.a.spelled(part)).tolist(), self.b.encode(part[1:])

    def tokens(self, part: str) -> tuple[Tokens, Tokens] | None:
        """The tokens of a part that begins with a space, with their ends in it; None if their bytes are not the part's."""
        a, b = self.ids(part)
        a_bytes, b_bytes, own = [self.a_bytes[index] for index in a], [self.pieces[index] for index in b], part.encode()
        if b"".join(a_bytes) != own or b"".join(b_bytes) != own:
            return None
        return tuple((np.array(ids, np.int64), np.cumsum(list(map(len, found)), dtype=np.int64)) for ids, found in ((a, a_bytes), (b, b_bytes)))

    def groups(self, both: tuple[Tokens, Tokens]) -> Closed:
        """The groups of tokens that begin at a common end and end at one."""
        (a, a_ends), (b, b_ends) = both
        if not len(a):
            return Closed()
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_cuts, b_cuts = (np.searchsorted(ends, common, side="right")[:-1] for ends in (a_ends, b_ends))
        text = ";".join(f"{numbers(x)}|{numbers(y)}" for x, y in zip(np.split(a, a_cuts), np.split(b, b_cuts)))
        ends = np.union1d(a_ends, b_ends)
        codes = a[np.searchsorted(a_ends, ends)] * self.b_ids + b[np.searchsorted(b_ends, ends)]
        return Closed(len(a), len(b), len(common), codes.astype(self.code_type).tobytes(), text)

    def fragment(self, both: tuple[Tokens, Tokens]) -> Fragment:
        """The fragment of tokens that end within a range; a token's end counts from the text's beginning."""
        (a, a_ends), (b, b_ends) = both
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not len(common):
            return Fragment(prefix=both)
        cuts = [np.searchsorted(ends, common[[0, -1]], side="right") for ends in (a_ends, b_ends)]
        sides = ((a, a_ends), (b, b_ends))
        prefix, middle, suffix = (
            tuple((ids[chosen], ends[chosen]) for (ids, ends), chosen in zip(sides, places))
            for places in zip(*((slice(0, low), slice(low, high), slice(high, None)) for low, high in cuts))
        )
        return Fragment(prefix, self.groups(middle), suffix, True)

    def compose(self, one: Fragment, other: Fragment) -> Fragment:
        whole = one.whole and other.whole
        if not one.cut:
            return Fragment(chained(one.prefix, other.prefix), other.closed, other.suffix, other.cut, whole)
        if not other.cut:
            return Fragment(one.prefix, one.closed, chained(one.suffix, other.prefix), True, whole)
        between = self.groups(chained(one.suffix, other.prefix))
        return Fragment(one.prefix, one.closed + between + other.closed, other.suffix, True, whole)

    def word(self, part: str) -> Closed | None:
        """The closed fragment of the bytes between two places where both tokenizers cut; None if they are not whole."""
        a, b = self.ids(part)
        if len(a) + len(b) <= FEW_TOKENS:
            return self.walked(a, b, part.encode())
        both = self.tokens(part)
        return None if both is None else self.groups(both)

    def walked(self, a: list[int], b: list[int], own: bytes) -> Closed | None:
        """What `groups` finds for any number of tokens, found for a few by walking along both sides."""
        a_bytes, b_bytes = [self.a_bytes[index] for index in a], [self.pieces[index] for index in b]
        if b"".join(a_bytes) != own or b"".join(b_bytes) != own:
            return None
        names, b_ids = self.names, self.b_ids
        closed, codes = [], []
        i = j = first_a = first_b = 0
        a_end, b_end, last = len(a_bytes[0]), len(b_bytes[0]), len(own)
        while True:
            codes.append(a[i] * b_ids + b[j])
            if a_end < b_end:
                i += 1
                a_end += len(a_bytes[i])
            elif b_end < a_end:
                j += 1
                b_end += len(b_bytes[j])
            else:
                i, j = i + 1, j + 1
                closed.append(f"{','.join([names[x] for x in a[first_a:i]])}|{','.join([names[x] for x in b[first_b:j]])}")
                if a_end == last:
                    return Closed(i, j, len(closed), array(self.array_code, codes).tobytes(), ";".join(closed))
                first_a, first_b = i, j
                a_end += len(a_bytes[i])
                b_end += len(b_bytes[j])

    def learn(self, texts: list[str]) -> None:
        """Remembers all words of the texts that are new; the sentence pieces of many words cost less than word by word."""
        words = {word for text in texts for word in text.split(" ")}
        new = [word for word in words if word not in self.known and word and len(word) <= LONGEST_KEPT and not word[0].isspace()]
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known.clear()
            new = [word for word in words if word and len(word) <= LONGEST_KEPT and not word[0].isspace()]
        for word, b in zip(new, self.b.encode(new, num_threads=1)):
            a = array("I", self.a.word(word)).tolist()
            own = " " + word
            self.known[word] = self.walked(a, b, own.encode()) if len(a) + len(b) <= FEW_TOKENS else self.word(own)

    def remembered(self, word: str) -> Closed | None:
        """`word` with a space before it, from memory if it was seen."""
        if word in self.known:
            return self.known[word]
        if not word or word[0].isspace():
            raise Unsplit
        found = self.word(" " + word)
        if len(word) <= LONGEST_KEPT:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def chain(self, words: list[Closed | None]) -> Closed | None:
        """Many closed fragments composed at once; None if one is not whole."""
        if None in words:
            return None
        return Closed(
            sum([word.n_a for word in words]), sum([word.n_b for word in words]), sum([word.n for word in words]),
            b"".join([word.codes for word in words]), ";".join([word.text for word in words]),
        )

    def text(self, text: str) -> Closed:
        """The groups of a whole text; none if it is empty or not whole."""
        if not text:
            return Closed()
        try:
            words = list(map(self.remembered, text.split(" ")))
        except Unsplit:
            words = list(map(self.word, spaced_words(" " + text)))
        return self.chain(words) or Closed()

    def range(self, window: bytes, begin: int, low: int, high: int) -> Fragment:
        """The fragment of the bytes from `low` to `high`; the window around them begins at `begin`, where both tokenizers cut."""
        found, at = Fragment(), begin
        closed: list[Closed | None] = []

        def with_closed() -> Fragment:
            own = self.chain(closed) if closed else Closed()
            return Fragment(found.prefix, found.closed + (own or Closed()), found.suffix, found.cut, found.whole and own is not None)

        for part in spaced_words(window.decode()):
            end = at + len(part.encode())
            if at >= low and end <= high and found.cut and not len(found.suffix[0][0]):
                try:
                    closed.append(self.remembered(part[1:]))
                except Unsplit:
                    closed.append(self.word(part))
            elif end > low and at < high:
                found, closed = with_closed(), []
                both = self.tokens(part)
                if both is None:
                    found.whole = False
                else:
                    inside = tuple((ids[kept], ends[kept] + at) for ids, ends in both for kept in [(ends + at > low) & (ends + at <= high)])
                    found = self.compose(found, self.fragment(inside))
            at = end
        return with_closed()


def places_to_cut(data: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """(low, high, window's begin, window's end) of ranges of about `size` bytes; a range without a place where both tokenizers cut joins the next."""
    codes = np.frombuffer(data, np.uint8)
    space = codes == 32
    after = np.r_[codes[1:], 32]
    # What follows the space is no white space: neither ASCII's nor, by its first byte, another.
    plain = (after > 32) & ~np.isin(after, [0xC2, 0xE1, 0xE2, 0xE3])
    safe = np.flatnonzero(space & plain & ~np.r_[True, space[:-1]])
    edges, low = [0], 0
    for high in range(size, len(data), size):
        if np.searchsorted(safe, high) > np.searchsorted(safe, low):
            edges.append(high)
            low = high
    edges.append(len(data))
    stops = np.r_[0, safe, len(data)]
    return [
        (low, high, int(stops[np.searchsorted(stops, low, side="right") - 1]), int(stops[np.searchsorted(stops, high)]))
        for low, high in zip(edges[:-1], edges[1:])
    ]


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, codes binary, groups string"
ALIGNED_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("codes", pa.binary()), ("groups", pa.string()),
])
RANGE_SCHEMA = pa.schema([(name, pa.int64()) for name in ("key", "doc_id", "number", "low", "high", "begin")] + [("window", pa.binary())])
ENDS = ("prefix_a", "prefix_b", "suffix_a", "suffix_b")
FRAGMENT_SCHEMA = pa.schema([
    ("key", pa.int64()), ("doc_id", pa.int64()), ("number", pa.int64()), ("whole", pa.bool_()), ("cut", pa.bool_()),
    *((f"{name}_{what}", pa.binary()) for name in ENDS for what in ("ids", "ends")),
    ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("codes", pa.binary()), ("groups", pa.string()),
])
FRAGMENT = ", ".join(f"{f.name} {({pa.int64(): 'long', pa.bool_(): 'boolean', pa.binary(): 'binary'}).get(f.type, 'string')}" for f in FRAGMENT_SCHEMA)


def as_row(key: int, doc_id: int | None, number: int, found: Fragment) -> tuple:
    open_ends = [values.tobytes() for side in (found.prefix, found.suffix) for tokens in side for values in tokens]
    closed = found.closed
    return key, doc_id, number, found.whole, found.cut, *open_ends, closed.n_a, closed.n_b, closed.n, closed.codes, closed.text


def as_fragment(row: dict) -> Fragment:
    a, b, c, d = (tuple(np.frombuffer(row[f"{name}_{what}"], np.int64) for what in ("ids", "ends")) for name in ENDS)
    return Fragment((a, b), Closed(row["n_a"], row["n_b"], row["n_groups"], row["codes"], row["groups"]), (c, d), row["cut"], row["whole"])


def result(doc_id: int | None, closed: Closed, digest: bool) -> tuple:
    text = (hashlib.sha256(closed.text.encode()).hexdigest() if closed.n else "") if digest else closed.text
    return doc_id, closed.n_a, closed.n_b, closed.n, closed.n_a + closed.n_b - closed.n, closed.codes, text


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*rows), schema)], schema=schema)


def short_texts(docs: DataFrame, byte_path: str, piece_path: str, digest: bool) -> DataFrame:
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        for batch in slices(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            aligner.learn(texts)
            rows = [result(key, aligner.text(text), digest) for key, text in zip(batch.column("doc_id").to_pylist(), texts)]
            yield batch_of(rows, ALIGNED_SCHEMA)

    return docs.mapInArrow(tasks, ALIGNED)


def long_texts(docs: DataFrame, byte_path: str, piece_path: str, digest: bool, range_bytes: int) -> DataFrame:
    """As `short_texts`, of rows with a unique `key`: ranges of a text in several tasks, then a tree of fragments."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for key, doc_id, text in zip(*(batch.column(name).to_pylist() for name in ("key", "doc_id", "text"))):
                data = b" " + text.encode()
                for number, (low, high, begin, end) in enumerate(places_to_cut(data, range_bytes)):
                    yield batch_of([(key, doc_id, number, low, high, begin, data[begin:end])], RANGE_SCHEMA)

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        for batch in slices(batches, "window"):
            rows = [as_row(r["key"], r["doc_id"], r["number"], aligner.range(r["window"], r["begin"], r["low"], r["high"])) for r in batch.to_pylist()]
            yield batch_of(rows, FRAGMENT_SCHEMA)

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        for (key, step), columns in groups(batches, ["key", "step"]):
            total = Fragment()
            for row in zip(*columns.values()):
                total = aligner.compose(total, as_fragment(dict(zip(columns, row))))
            yield batch_of([as_row(key, columns["doc_id"][0], step, total)], FRAGMENT_SCHEMA)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        for batch in batches:
            for row in batch.to_pylist():
                # A text begins at a common end, and all its bytes end at one.
                found = aligner.compose(Fragment(cut=True), as_fragment(row))
                yield batch_of([result(row["doc_id"], found.closed if found.whole else Closed(), digest)], ALIGNED_SCHEMA)

    cut = docs.mapInArrow(ranges, "key long, doc_id long, number long, low long, high long, begin long, window binary")
    found = stored(cut.repartition("key", "number").mapInArrow(fragments, FRAGMENT), "alignment-fragments")
    while not found.where("number > 0").isEmpty():
        steps = found.withColumn("step", F.floor(F.col("number") / FAN).cast("long"))
        dealt = steps.repartition("key", "step").sortWithinPartitions("key", "step", "number")
        found = stored(dealt.mapInArrow(composed, FRAGMENT), "alignment-fragments")
    return found.mapInArrow(finished, ALIGNED)


def aligned(docs: DataFrame, byte_path: str, piece_path: str, digest: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, the links' codes (A id * number of B ids + B id, little-endian) and the groups, or their SHA-256."""
    named = docs.select(F.col("doc_id").cast("long"), "text")
    is_long = F.coalesce(F.octet_length("text") > range_bytes, F.lit(False))
    # Numbered once and stored, so that a repeated task cannot number rows anew.
    keyed = stored(named.where(is_long).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"), "alignment-long")
    short = short_texts(named.where(~is_long), byte_path, piece_path, digest)
    return short.unionByName(long_texts(keyed, byte_path, piece_path, digest, range_bytes))


def pair_counts(found: DataFrame, b_ids: int, code_type: str) -> DataFrame:
    """(code, n, best): in how many rows each pair is linked, and whether that is the most for its A id; a stored table."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            codes, place = np.unique(np.concatenate([codes for codes, _ in held]), return_inverse=True)
            return codes, np.bincount(place, weights=np.concatenate([n for _, n in held]), minlength=len(codes)).astype(np.int64)

        for batch in slices(batches, "codes"):
            own = [np.unique(np.frombuffer(value, code_type)) for value in batch.column("codes").to_pylist()]
            codes, n = np.unique(np.concatenate(own), return_counts=True)
            held.append((codes, n))
            size += len(codes)
            if size > 2 * COUNTED_PAIRS:
                held = [merged()]
                size = len(held[0][0])
                if size > COUNTED_PAIRS:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].astype(np.int64)), pa.array(held[0][1])], names=["code", "n"])
                    held, size = [], 0
        if held:
            codes, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(n)], names=["code", "n"])

    counted = stored(found.select("codes").mapInArrow(tasks, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "alignment-counts")
    a = F.expr(f"code DIV {b_ids}")
    # One row for each id of the vocabulary.
    most = F.broadcast(counted.groupBy(a.alias("a")).agg(F.max("n").alias("most")))
    return stored(counted.withColumn("a", a).join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-pairs")


def with_counts(found: DataFrame, pairs: DataFrame, code_type: str, broadcast_pairs: int) -> DataFrame:
    """The rows of a stored `found` with n_best and count_sum over their links."""
    spark = found.sparkSession
    # Counts above the limit belong to few enough pairs.
    limit = 0
    if pairs.count() > broadcast_pairs:
        by_count = pairs.groupBy("n").agg(F.count(F.lit(1)).alias("pairs")).orderBy(F.desc("n"))
        held = 0
        for row in by_count.toLocalIterator():  # one row for each distinct count, until the limit
            held += row["pairs"]
            if held > broadcast_pairs:
                limit = row["n"]
                break
    top = pairs.where(F.col("n") > limit).toPandas()  # at most `broadcast_pairs` rows
    order = np.argsort(top["code"].to_numpy(np.int64))
    shared = spark.sparkContext.broadcast((
        top["code"].to_numpy(np.int64)[order].astype(code_type), top["n"].to_numpy(np.int64)[order], top["best"].to_numpy(bool)[order],
    ))
    def place(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each code stands in the broadcast table, and whether it does."""
        known = shared.value[0]
        at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
        return at, (known[at] == codes if len(known) else np.zeros(len(codes), bool))

    kept = pa.schema([f for f in ALIGNED_SCHEMA if f.name != "codes"] + [("row", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, n, best = shared.value
        for batch in slices(batches, "codes"):
            sums = []
            for value in batch.column("codes").to_pylist():
                at, there = place(np.frombuffer(value, code_type))
                at = at[there]
                sums.append((int(best[at].sum()), int(n[at].sum())))
            columns = [batch.column(name) for name in kept.names[:-2]] + [pa.array(column, pa.int64()) for column in zip(*sums)]
            yield pa.RecordBatch.from_arrays([column.cast(f.type) for column, f in zip(columns, kept)], schema=kept)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "codes"):
            for row, value in zip(batch.column("row").to_pylist(), batch.column("codes").to_pylist()):
                codes = np.frombuffer(value, code_type)
                rare, times = np.unique(codes[~place(codes)[1]], return_counts=True)
                if len(rare):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rare), row)), pa.array(rare.astype(np.int64)), pa.array(times)], names=["row", "code", "times"])

    total = found.mapInArrow(summed, ALIGNED.replace("codes binary, ", "") + ", row long, n_best long, count_sum long")
    if not limit:
        return total
    rest = found.select("row", "codes").mapInArrow(others, "row long, code long, times long").join(pairs.where(F.col("n") <= limit), "code")
    sums = rest.groupBy("row").agg(F.sum(F.col("best").cast("long") * F.col("times")).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more"))
    return total.join(sums, "row", "left").withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0)),
    })


def align(docs: DataFrame, byte_path: str, piece_path: str, range_bytes: int = RANGE_BYTES, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    aligner = Aligner(byte_path, piece_path)
    b_ids, code_type = aligner.b_ids, aligner.code_type.str
    found = stored(
        aligned(docs, byte_path, piece_path, True, range_bytes).withColumn("row", F.monotonically_increasing_id()), "alignment-rows"
    )
    pairs = pair_counts(found, b_ids, code_type)
    return with_counts(found, pairs, code_type, broadcast_pairs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )
