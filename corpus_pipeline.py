"""From raw documents to packed training sequences, in five stages.

Each stage takes all documents that the one before kept, as a written table, and decides on all of
them; all but the last return the columns of `documents`:

1. `language` learns from the labelled texts of its input and drops what is no text in a learned language;
2. `lines` removes every line that has a similar line before it, and then the documents that have no word left:
   all they said stands in earlier ones;
3. `near_duplicates` leaves the document of the smallest id of each group, on runs of five words at 0.8, of what
   the lines left: copies whose lines were cut or joined differently, and documents of one changed line;
4. `mix` repeats and draws documents so that sources come near their target weights;
5. `pack` cuts the texts into sequences of at most 4,096 tokens; its rows are the pieces.

Nulls in any column, empty tables, repeated rows and extra columns are treated as the operators say;
extra columns pass through the first four stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidefare.llm import line_dedup, minhash, mixing, packing, ppm_language
from tidefare.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ppm_language.keep_known(docs, ppm_language.fit(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs).where(line_dedup.has_word("text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: The byte models of the first stage and the tokenizer of the last are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
