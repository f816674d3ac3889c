"""Samples and splits that depend only on row keys and a seed.

A row's place is the md5 of `seed:key`, so the result is the same under any partitioning,
retry or file layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DEFAULT_SEED = 42
#: A table of one short row for each of at most so many blocks is broadcast.
BROADCAST_BLOCKS = 100_000


def sample_key(seed: int, *keys: str) -> Column:
    """Uniform hex text that orders rows for a seed."""
    parts = [F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys]
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws("|", *parts)))


def _leading_part(place: Column) -> Column:
    """A place up to its second significant hex digit.

    Prefix order agrees with place order and each prefix spans at most 1/16 of what lies
    below it, so a few hundred prefixes locate the n-th smallest place to about 6 %.
    """
    zeros = F.length(place) - F.length(F.ltrim(place, F.lit("0")))
    return F.substring(place, F.lit(1), zeros + F.lit(2))


def seeded_sample(rows: DataFrame, n: int, *keys: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Exactly `n` rows (all, if there are fewer), the ones with the smallest places.

    A plain ORDER BY ... LIMIT sends n rows per input task to one task. Here a first pass,
    which reads the keys and the filter columns only, counts rows per leading part and finds
    where the n-th place lies; the second pass sorts just the rows up to there. `keys` should
    tell rows apart.
    """
    # A generator's output is computed once per row; a plain column would be hashed again
    # wherever the filter mentions it.
    placed = rows.select("*", F.explode(F.array(sample_key(seed, *keys))).alias("sample_place"))
    part = _leading_part(F.col("sample_place"))
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    # The unpartitioned frame covers one row per leading part.
    running = F.sum("rows").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, 0))
    cut = (
        counts.withColumn("seen", running)
        .filter(F.col("seen") >= n)
        .agg(F.min("part").alias("cut"))
    )
    # "g" sorts after every hex digit: with fewer than n rows in all, nothing is cut.
    return (
        placed.filter(part <= F.coalesce(cut.scalar(), F.lit("g")))
        .orderBy("sample_place", *keys)
        .limit(n)
        .drop("sample_place")
    )


def block_sample(
    rows: DataFrame,
    position: str,
    block_rows: int = 500_000,
    per_block: int = 10_000,
    max_blocks: int | None = None,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Up to `per_block` rows of every block of `block_rows` consecutive positions.

    `position` is a unique row number through the whole table, so no block can outgrow
    `block_rows`, and `max_blocks` keeps the first blocks. A first pass, which reads the
    position only, counts each block's rows per leading part of their places and so finds where
    the block's last drawn row lies; only the rows up to there, about 1.06 `per_block` of each
    block, are shuffled, sorted and ranked.
    """
    if max_blocks is not None:
        rows = rows.filter(F.col(position) < max_blocks * block_rows)
    block = F.floor(F.col(position) / F.lit(block_rows)).alias("sample_block")
    placed = rows.select("*", block, F.explode(F.array(sample_key(seed, position))).alias("sample_place"))
    part = _leading_part(F.col("sample_place"))
    counts = placed.groupBy("sample_block", part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    # A block has a few hundred leading parts.
    through = W.partitionBy("sample_block").orderBy("part").rowsBetween(W.unboundedPreceding, 0)
    cuts = (
        counts.withColumn("seen", F.sum("rows").over(through))
        .groupBy("sample_block")
        .agg(F.min(F.when(F.col("seen") >= per_block, F.col("part"))).alias("cut"))
    )
    last = rows.agg(F.max(position)).first()[0]
    if last is None or last // block_rows < BROADCAST_BLOCKS:  # one short row a block
        cuts = F.broadcast(cuts)
    order = W.partitionBy("sample_block").orderBy("sample_place", position)
    return (
        placed.join(cuts, "sample_block")
        .filter(part <= F.coalesce("cut", F.lit("g")))
        .withColumn("sample_rank", F.row_number().over(order))
        .filter(F.col("sample_rank") <= per_block)
        .select(*rows.columns)
    )


def in_train(*keys: str, percent: int = 80, seed: int = DEFAULT_SEED) -> Column:
    """Whether a row falls in the training part; a map-only test, stable across runs."""
    bucket = F.conv(F.substring(sample_key(seed, *keys), 1, 8), 16, 10).cast("long") % 100
    return bucket < percent


def train_test_split(
    rows: DataFrame, *keys: str, percent: int = 80, seed: int = DEFAULT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; without keys, a row's own values are its key."""
    chosen = in_train(*(keys or rows.columns), percent=percent, seed=seed)
    return rows.filter(chosen), rows.filter(~chosen)
