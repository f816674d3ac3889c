"""The registered queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefare.llm import (
    alignment, ftrl_toxicity, html_blocks, line_dedup, lz_fingerprint, minhash, mixing, packing, periodic_runs, ppm_language, repetition, suffix_groups, token_files,
)
from tidefare.llm.byte_tokens import byte_tokenizer
from tidefare.llm.common import remainder_of_crc, slices, table, utf8
from tidefare.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_lz_fingerprint(spark, sf_dir):
    return lz_fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op2_ppm_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder_of_crc("doc_id", 3) == 1)
    model = ppm_language.fit(docs.where(~F.col("held_out")))
    held_out = (remainder_of_crc("doc_id", 3) == 1).alias("held_out")
    return ppm_language.predict(docs, model).select("doc_id", held_out, "lang_pred", "score", "bits_per_byte")


def op3_ftrl_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder_of_crc("doc_id", 5) != 0)
    weights = ftrl_toxicity.fit(docs, labels)
    held_out = (remainder_of_crc("doc_id", 5) == 0).alias("held_out")
    return ftrl_toxicity.score(docs, weights).select("doc_id", held_out, "score", "predicted")


def op4_prefix_lines(spark, sf_dir):
    return line_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op5_block_tree(spark, sf_dir):
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op6_cost_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_suffix_repetition(spark, sf_dir):
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op8_circulant_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op9_suffix_groups(spark, sf_dir):
    return suffix_groups.remove_repeats(table(spark, sf_dir, "documents"))


def op10_water_filling(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op11_fragment_monoid(spark, sf_dir):
    return alignment.align(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def with_repeated_ends(docs: DataFrame) -> DataFrame:
    """doc_id, text; in every tenth document, by crc32 of its id, the words from one on repeat in turn. A null id is no tenth one."""

    def repeated(words: list[bytes], turn: int) -> list[bytes]:
        at = turn % len(words)
        period = words[at:at + 1 + (len(words) - at) // (3 + turn % 8)]
        return words[:at] + (period * (len(words) // len(period) + 1))[:len(words) - at]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch)
            for row, code in enumerate(batch.column("code").to_pylist()):
                words = texts[row].split() if code is not None and code % 10 == 0 else None
                if words:
                    texts[row] = b" ".join(repeated(words, code // 10))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    named = docs.select(F.col("doc_id").cast("long"), "text")
    return named.withColumn("code", F.crc32(F.col("doc_id").cast("string").cast("binary"))).mapInArrow(tasks, "doc_id long, text string")


def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs.find_runs(with_repeated_ends(table(spark, sf_dir, "documents")))
    written = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    best = {name: F.col(f"strongest.{name}") for name in ("start", "length", "period")}
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(column.alias(name) for name, column in best.items()),
        F.expr("strongest.length * 1000 DIV strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_range_coded_ids(spark, sf_dir):
    path, tokenizer = scratch_path(spark, "token-table"), public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_table(table(spark, sf_dir, "documents"), path, tokenizer)
    found = token_files.read_token_table(spark, path, byte_tokenizer(tokenizer).get_vocab_size())
    return found.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_lz_fingerprint, op2_ppm_language, op3_ftrl_toxicity, op4_prefix_lines, op5_block_tree, op6_cost_packing, op7_suffix_repetition, op8_circulant_minhash,
        op9_suffix_groups, op10_water_filling, op11_fragment_monoid, op12_periodic_runs, op13_range_coded_ids,
    )
}
