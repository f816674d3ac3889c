"""Language identification by prediction by partial matching.

For every language a context tree over bytes, of depth `ORDER`, is counted from labelled documents
and then frozen. A byte's code length in a language follows from the longest context that its tree
holds: with n occurrences of the context, q different successors and c of this byte, the byte costs
-log2(c / (n + q)) if c > 0, else an escape of -log2(q / (n + q)) and the cost in the context one byte
shorter; below the empty context every byte costs 8 bits. A text's code length is the sum over all
its bytes, the first ones in the context of line feeds. The language with the shortest code wins.

Frozen statistics make the code length a function of a context node and a byte. The trees of all
languages share their nodes, so a task finds the node of each position with one table lookup a level
and then adds the row of costs of all languages: whole texts, no sampling.

Fitting takes at most `DOCUMENTS_PER_LANGUAGE` labelled documents of each language, those of the
smallest hashes; contexts are counted inside tasks and summed by Spark. Languages are learned in
order of name, so equal code lengths give the first name.

Null texts and texts without a letter are `und` with score 0. The score is the probability of the
winner if every language is as likely beforehand. Each input row gives one row, also if rows repeat;
an empty table gives none. With nothing to learn from, every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefare.llm.common import joined, slices, stored, utf8

ORDER = 3
DOCUMENTS_PER_LANGUAGE = 1500
#: Contexts seen less often than this in all languages together are left out of the trees.
LEAST_SEEN = 4
#: A table with one row for each of at most so many languages is broadcast.
BROADCAST_LANGUAGES = 10_000
#: Nodes whose costs are worked out together, so that the driver holds little more than the model.
NODES_AT_ONCE = 256
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: A text that no language codes in fewer bits than it has is rejected; ordinary text takes two to four bits a byte.
MOST_BITS_PER_BYTE = 8.0


@dataclass
class LanguageModel:
    """`symbols`: byte to symbol; `steps[d]`: node and symbol d + 1 bytes back to node; `costs`: node and symbol to bits."""

    languages: list[str]
    symbols: np.ndarray
    steps: list[np.ndarray]
    costs: np.ndarray

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths, a row for each text and a column for each language."""
        order, lead = len(self.steps), b"\n" * len(self.steps)
        buffer = self.symbols[np.frombuffer(lead + lead.join(texts), np.uint8)].astype(np.int32)
        width = int(self.symbols.max()) + 1
        node = np.zeros(len(buffer) - order, np.int32)
        for back, step in enumerate(self.steps, 1):
            node = step[node * width + buffer[order - back:len(buffer) - back]]
        cells = node * width + buffer[order:]
        lengths = np.array([len(text) for text in texts])
        starts = np.cumsum(lengths + order) - lengths - order
        result = np.zeros((len(texts), len(self.languages)))
        for at in np.flatnonzero(lengths):
            own = cells[starts[at]:starts[at] + lengths[at]]
            result[at] = self.costs[own].sum(axis=0, dtype=np.float64)
        return result


def training_sample(labelled: DataFrame, per_language: int = DOCUMENTS_PER_LANGUAGE) -> DataFrame:
    """At most `per_language` rows (text, lang) of each language, by hash of doc_id."""
    named = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = stored(named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-counts")
    # The hash is even, so twice the share that is needed holds enough rows and few of them are ranked.
    unit = (F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 31) - 1)) / float(1 << 31)).alias("unit")
    return (
        joined(named.select("doc_id", "lang", "text", unit), share, "lang", BROADCAST_LANGUAGES)
        .where(F.col("unit") * F.col("n") <= 2 * per_language)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("unit", "doc_id")))
        .where(F.col("rank") <= per_language)
        .select("text", "lang")
    )


def context_counts(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): how often each run of order + 1 bytes occurs, as a number."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = b"\n" * order
        for batch in slices(batches):
            texts, names = utf8(batch), batch.column("lang").to_pylist()
            for name in sorted(set(names)):
                buffer = np.frombuffer(lead + lead.join(t for t, own in zip(texts, names) if own == name), np.uint8).astype(np.int64)
                grams = sum(buffer[k:len(buffer) - order + k] << (8 * (order - k)) for k in range(order + 1))
                values, counts = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(values)), pa.array(values), pa.array(counts)], schema=schema)

    out = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])
    return sample.mapInArrow(tasks, out).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def node_costs(shorter: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Costs (node, symbol, language) of nodes with these counts, whose contexts one byte shorter cost `shorter`."""
    total, kinds = table.sum(axis=1, keepdims=True), (table > 0).sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        coded = -np.log2(table / (total + kinds))
        escaped = shorter - np.log2(kinds / (total + kinds))
    return np.where(total == 0, shorter, np.where(table > 0, coded, escaped))


def build_model(languages: list[str], grams: np.ndarray, language: np.ndarray, counts: np.ndarray, order: int = ORDER, least_seen: int = LEAST_SEEN) -> LanguageModel:
    """Frozen trees from counted runs of bytes; beside the model itself, it holds one level above the last and `NODES_AT_ONCE` nodes in full precision."""
    last = grams & 255
    used = np.unique(np.concatenate([last, [10]]))
    symbols = np.full(256, len(used), np.uint8)  # a byte never seen is a symbol of its own
    symbols[used] = np.arange(len(used))
    width = len(used) + 1
    many = max(1, len(languages))
    # Nodes of a level follow those of the level above: how many nodes there are before each level, and the nodes one byte shorter.
    steps, firsts, owners = [], [0, 1], [np.zeros(1, np.int64)]
    level = np.zeros(len(grams), np.int64)  # each gram's node so far, or -1 once its context is left out
    levels = [level]
    for depth in range(1, order + 1):
        before = symbols[(grams >> (8 * depth)) & 255].astype(np.int64)
        found, where = np.unique(np.where(level >= 0, level * width + before, -1), return_inverse=True)
        seen = np.bincount(where, weights=counts)
        new = (found >= 0) & (seen >= least_seen)
        number = np.full(len(found), -1)
        number[new] = firsts[-1] + np.arange(new.sum())
        step = np.repeat(np.arange(firsts[-1], dtype=np.int32), width)
        step[found[new]] = number[new]
        steps.append(step)
        level = number[where]
        levels.append(level)
        owners.append(found[new] // width)
        firsts.append(firsts[-1] + int(new.sum()))

    costs = np.empty((firsts[-1], width, many), np.float32)
    above, above_first = np.full((1, width, many), 8.0), 0  # the empty context escapes to 8 bits
    cell = symbols[last].astype(np.int64) * many + language
    for depth, (level, owner) in enumerate(zip(levels, owners)):
        first, through = firsts[depth], firsts[depth + 1]
        # Only a level that another one follows is kept in full precision.
        exact = np.empty((through - first, width, many)) if depth < order else None
        by_node = np.argsort(level, kind="stable")
        edges = np.searchsorted(level[by_node], np.arange(first, through + NODES_AT_ONCE, NODES_AT_ONCE))
        for at, a, b in zip(range(first, through, NODES_AT_ONCE), edges[:-1], edges[1:]):
            own, nodes = by_node[a:b], slice(at, min(through, at + NODES_AT_ONCE))
            size = (nodes.stop - at) * width * many
            table = np.bincount((level[own] - at) * width * many + cell[own], counts[own], size).reshape(-1, width, many)
            rows = node_costs(above[owner[at - first:nodes.stop - first] - above_first], table)
            costs[nodes] = rows
            if exact is not None:
                exact[at - first:nodes.stop - first] = rows
        above, above_first = exact, first
    return LanguageModel(languages, symbols, steps, costs.reshape(-1, many))


def fit(labelled: DataFrame, order: int = ORDER, per_language: int = DOCUMENTS_PER_LANGUAGE) -> LanguageModel:
    """The counts come to the driver: their number follows the bounded sample."""
    counted = context_counts(training_sample(labelled, per_language), order).toArrow().combine_chunks()
    coded = counted.column("lang").combine_chunks().dictionary_encode()
    languages = sorted(coded.dictionary.to_pylist())
    place = {name: k for k, name in enumerate(languages)}
    number = np.array([place[name] for name in coded.dictionary.to_pylist()], np.int64)
    return build_model(languages, counted.column("gram").to_numpy(), number[coded.indices.to_numpy()], counted.column("n").to_numpy(), order)


PREDICTIONS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("bits_per_byte", T.DoubleType()),
])


def _predicted(model: LanguageModel, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    known = np.array([bool(model.languages) and LETTER.search(text.decode()) is not None for text in texts], bool)
    if not known.any():
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    bits = model.bits(texts)
    best = bits.argmin(axis=1)
    least = bits.min(axis=1)
    score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
    per_byte = least / np.maximum(1, [len(text) for text in texts])
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
    return names, np.where(known, score, 0.0), np.where(known, per_byte, 0.0)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score and bits_per_byte of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(**shared.value)
        for batch in slices(batches):
            names, score, per_byte = _predicted(model, utf8(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(per_byte)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tasks, PREDICTIONS)


def keep_known(docs: DataFrame, model: LanguageModel, most_bits: float = MOST_BITS_PER_BYTE) -> DataFrame:
    """The documents, with all their columns, that are text in a learned language: not `und`, and coded in
    at most `most_bits` bits a byte."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(**shared.value)
        for batch in slices(batches):
            names, _, per_byte = _predicted(model, utf8(batch))
            kept = [name != UNKNOWN and bits <= most_bits for name, bits in zip(names, per_byte)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(tasks, docs.schema)
