"""Mixing sources to target weights by capped water-filling.

Sources are ordered by code point, null last, and weighted 1, 2, 3, repeating. All sources together
get as many words as the documents hold, in proportion to weight; a source never gets more than
`MAX_EPOCHS` times its own words, and what it cannot take is shared out again by weight until no
source is above its cap. That fixed point has a closed form: with sources in ascending order of cap
over weight, a source is clamped exactly if its cap is within the level that the words left and the
weights left give, and the level of the first one that is not clamped holds for all the others.

A target of f times a source's words means every document floor(f) times, and a seeded draw of
documents once more. The draw takes documents in the order of a hash of the seed and doc_id until
their words come nearest to the fraction. It finds its cut with two counts, of 32,768 hash ranges a
source and then of the hashes inside the range that holds the cut, so a source with a third of all
rows is never gathered or sorted. Reruns, and any partitioning, give the same mix.

Null and empty texts have size 0 and take 0 words. Rows with the same doc_id are drawn together.
Null doc_ids hash as the empty text. An empty table gives no rows. The table of sources has one row
each and passes through one task; it is broadcast only if it has at most `BROADCAST_ROWS` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefare.llm.common import WORD, stored

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix"
CELL_BITS = 15
#: Rows of (source, numbers), about 100 bytes each.
BROADCAST_ROWS = 20_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def place(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """Where a document stands in the draw: 30 bits of a hash."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    return F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 2)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from rows of (source, size)."""
    cycle = F.array(*map(F.lit, weights))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = {name: F.sum(name).over(everything) - F.coalesce(F.sum(taken).over(before), F.lit(0)) for name, taken in (("source_size", "cap"), ("weight", "weight"))}
    return (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumns({"words_left": left["source_size"], "weight_left": left["weight"]})
        .withColumn("clamped", F.col("cap") * F.col("weight_left") <= F.col("words_left") * F.col("weight"))
        .withColumn("level", F.max(F.when(~F.col("clamped"), F.col("words_left") / F.col("weight_left"))).over(everything))
        .select("source", "source_size", F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")).alias("target"))
    )


def source_plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target, repeats, below) from rows of (source, size, place): every document
    `repeats` times, and once more if its place is under `below`."""
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = stored(
        source_targets(sizes, weights, max_epochs)
        .withColumn("repeats", F.least(ratio, F.lit(max_epochs)).cast("long"))
        .withColumn("fraction", F.col("target") - F.col("repeats") * F.col("source_size")),
        "source-targets",
    )

    def crossing(rows: DataFrame, cell: str, known: DataFrame) -> DataFrame:
        """The cell of each source in which its running words reach the fraction."""
        running = Window.partitionBy("source").orderBy(cell)
        summed = rows.groupBy("source", cell).agg(F.sum("size").alias("cell_size"))
        return (
            with_small(summed, known)
            .withColumn("through", F.col("passed") + F.sum("cell_size").over(running))
            .where((F.col("through") >= F.col("fraction")) & (F.col("through") - F.col("cell_size") < F.col("fraction")))
        )

    coarse = F.shiftright("place", CELL_BITS)
    first = crossing(
        sizes.withColumn("cell", coarse), "cell", targets.select("source", "fraction", F.lit(0).cast("long").alias("passed"))
    ).select("source", "fraction", "cell", (F.col("through") - F.col("cell_size")).alias("passed"))
    first = stored(first, "source-cells")
    inside = sizes.withColumn("cell", coarse).alias("s").join(
        first.select(F.col("source").alias("at"), F.col("cell").alias("at_cell")).hint("broadcast" if _few(first) else "merge"),
        F.col("s.source").eqNullSafe(F.col("at")) & (F.col("s.cell") == F.col("at_cell")),
        "left_semi",
    )
    second = crossing(inside, "place", first.select("source", "fraction", "passed")).select(
        "source", (F.col("place") + (F.col("through") - F.col("cell_size") / 2 <= F.col("fraction")).cast("int")).alias("below")
    )
    return stored(
        with_small(targets, second, keep=True).select(
            "source", "source_size", "target", "repeats",
            F.when(F.col("fraction") <= 0, 0).otherwise(F.coalesce("below", F.lit(1 << 30))).cast("long").alias("below"),
        ),
        "source-plan",
    )


def _few(small: DataFrame) -> bool:
    return small.count() <= BROADCAST_ROWS


def with_small(rows: DataFrame, by_source: DataFrame, keep: bool = False, check: bool = False) -> DataFrame:
    """Joins columns known per source; null sources match null. `check`: broadcasts them if they are few."""
    named = by_source.withColumnRenamed("source", "__source")
    if check and _few(by_source):
        named = F.broadcast(named)
    return rows.join(named, rows["source"].eqNullSafe(named["__source"]), "left" if keep else "inner").drop("__source")


def measured(docs: DataFrame, seed: str = SEED) -> DataFrame:
    return docs.select("doc_id", "source", word_count().alias("size"), place(seed=seed).alias("place"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies for every document."""
    sizes = stored(measured(docs, seed), "document-sizes")
    return with_small(sizes, source_plan(sizes, weights, max_epochs), check=True).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * _copies()).alias("taken"), _copies().alias("copies"),
    )


def _copies() -> Column:
    return F.col("repeats") + (F.col("place") < F.col("below")).cast("long")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, with its own columns."""
    sizes = stored(measured(docs, seed).drop("doc_id"), "document-sizes")
    plan = source_plan(sizes, weights, max_epochs).select("source", "repeats", "below")
    whole = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    rows = with_small(docs.select(whole, "source", place(seed=seed).alias("place")), plan, check=True)
    times = F.transform(F.sequence(F.lit(1), F.lit(max_epochs)), lambda k: F.when(k <= _copies(), k))
    return rows.withColumn("__copy", F.explode(F.array_compact(times))).select("row.*")
