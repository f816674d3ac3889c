"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, neighbouring pairs, and pairs with one word between, each
hashed to one of 2**BITS coordinates; words are lower-cased in ASCII and end at ASCII punctuation or
white space. Training makes FTRL-proximal updates with a rate per coordinate; L1 leaves most weights
at zero, so the model is a short list of (coordinate, weight).

The model is fitted on at most `PER_CLASS` labelled documents of each class, those of the smallest
hashes; that bounded sample trains in one task, since each update follows from the ones before it.
Updates from the rarer class weigh more, by the ratio of the classes to the power `HEAVIER`.

A document counts as toxic if any of its label rows says so; null labels are ignored. Null and empty
texts have no features and score by the intercept. Each input row gives one row, also if rows repeat;
an empty table gives none. With no labels at all, every score is one half less a hair (predicted 0).
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefare.llm.common import RunHashes, Words, mixed, slices, utf8

BITS = 20
PER_CLASS = 3000
EPOCHS = 8
ALPHA, BETA, L1, L2 = 2.0, 1.0, 10.0, 0.1
HEAVIER = 0.7
PLAIN = bytes(32 if chr(k) in string.punctuation else ord(chr(k).lower()) if k < 128 else k for k in range(256))


def plain_words(texts: list[bytes], runs: RunHashes) -> Words:
    """Words of ASCII-lower-cased texts in which ASCII punctuation separates as white space does."""
    return Words([text.translate(PLAIN) for text in texts], runs)


def occurrences(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The coordinate of each word, neighbouring pair and skipping pair, with repetitions."""
    shift = np.uint64(64 - bits)
    with np.errstate(over="ignore"):
        first = hashes * np.uint64(0x9E3779B97F4A7C15)
        parts = [hashes, first[:-1] + hashes[1:], (first[:-2] ^ np.uint64(0x5851F42D4C957F2D)) + hashes[2:]]
    return np.concatenate([mixed(part) >> shift for part in parts]).astype(np.int64)


def train(examples: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS, seed: int = 0) -> dict[int, float]:
    """The non-zero weights by coordinate; coordinate 2**bits is the intercept, which has no L1."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    limit = np.full(size, L1)
    limit[-1] = 0.0
    order = np.random.default_rng(seed)
    positive = sum(label for _, label in examples)
    heavier = ((len(examples) - positive) / max(1, positive)) ** HEAVIER  # the rarer class counts more

    def weights(at: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z[at]) <= limit[at], 0.0, -(z[at] - np.sign(z[at]) * limit[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for k in order.permutation(len(examples)):
            at, label = examples[k]
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            gradient *= heavier if label else 1.0
            sigma = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - sigma * w
            n[at] += gradient * gradient
    final = weights(np.arange(size))
    return {int(at): float(final[at]) for at in np.flatnonzero(final)}


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """At most `per_class` rows (doc_id, text, toxic) of each class."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    place = F.xxhash64(F.col("doc_id"), F.lit("toxic"))
    picked = None
    for label in (0, 1):
        some = known.where(F.col("toxic") == label).orderBy(place, "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    # Bounded: 2 * per_class rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return rows.groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, per_class: int = PER_CLASS) -> dict[int, float]:
    """Non-zero weights by coordinate; they are few because of L1."""

    def whole_sample(rows: pd.DataFrame) -> pd.DataFrame:
        runs = RunHashes()
        examples = []
        for _, row in rows.sort_values("doc_id").iterrows():
            found = np.unique(occurrences(plain_words([(row["text"] or "").encode()], runs).of(0), bits))
            examples.append((np.append(found, 1 << bits).astype(np.int32), int(row["toxic"])))
        weights = train(examples, bits)
        return pd.DataFrame({"at": list(weights.keys()), "weight": list(weights.values())}).astype({"at": "int64", "weight": "float64"})

    sample = training_sample(docs, labels, per_class)
    return {row["at"]: row["weight"] for row in sample.groupBy().applyInPandas(whole_sample, "at long, weight double").collect()}


SCORES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("predicted", T.IntegerType()),
])


def score(docs: DataFrame, weights: dict[int, float], bits: int = BITS) -> DataFrame:
    """doc_id, score and predicted of every row."""
    at = np.array(sorted(weights), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((at, np.array([weights[k] for k in at.tolist()], np.float64)))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coordinates, values = shared.value
        dense = np.zeros((1 << bits) + 1, np.float32)
        dense[coordinates] = values
        runs = RunHashes()
        for batch in slices(batches):
            margins = []
            words = plain_words(utf8(batch), runs)
            for k in range(batch.num_rows):
                found = occurrences(words.of(k), bits)
                margins.append(float(dense[np.unique(found[dense[found] != 0])].sum(dtype=np.float64) + dense[-1]))
            result = 1 / (1 + np.exp(-np.clip(np.array(margins), -35, 35)))
            if not len(coordinates):
                result = np.full(len(margins), np.nextafter(0.5, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(result, pa.float64()), pa.array((result >= 0.5).astype(np.int32))], schema=schema
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tasks, SCORES)
