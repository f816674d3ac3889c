"""As-of join: each row of one side with the latest row of the other, per key, at or before its time.

A range join would meet every pair of a key. Here both sides are laid end to end, sorted by time and
the last value is carried forward, one shuffle for everything. A key that holds most of the rows is
split by time: slots are cut at quantiles of the time of both sides, so that a slot of all keys
together, and so of any one key, holds about `SLOT_ROWS` rows. What a slot starts with is carried over from the
last value of each earlier slot of its key, a table of one row for each key and slot that occurs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOT_ROWS = 2_000_000
#: More slots would need finer quantiles than the sketch gives.
MOST_SLOTS = 5_000


def _slot(micros: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at or below a time, by bisection."""
    if not bounds:
        return F.lit(0)
    steps = [1 << bit for bit in reversed(range(len(bounds).bit_length()))]
    listed = F.lit(bounds + [(1 << 63) - 1] * (2 * steps[0] - 1 - len(bounds)))
    return F.aggregate(
        F.lit(steps), F.lit(0),
        lambda below, step: F.when(F.element_at(listed, below + step) <= micros, below + step).otherwise(below),
    )


def _bounds(times: DataFrame, slot_rows: int) -> list[int]:
    """Times that cut the rows into slots of about equal numbers; at most `MOST_SLOTS` numbers reach the driver."""
    rows = times.count()
    slots = min(MOST_SLOTS, -(-rows // slot_rows))
    if slots < 2:
        return []
    cuts = [k / slots for k in range(1, slots)]
    return sorted(set(times.agg(F.percentile_approx("micros", cuts, 10 * MOST_SLOTS)).first()[0] or []))


def asof_join(
    rows: DataFrame,
    others: DataFrame,
    *keys: str,
    time: str,
    others_time: str,
    values: tuple[str, ...],
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """`rows` with the `values` of the latest of `others` of the same keys, at or before their time.

    Rows without one, with a null key or with a null time get nulls; others with a null key or time are
    never met. Among others of one key and time, the greatest values, in their order, are taken. Repeated
    rows are kept. Times are timestamps; the columns of `rows` may have any names but those of `values`.
    """
    clash = set(values) & set(rows.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    key = F.struct(*(F.col(f"`{name}`").alias(f"k{k}") for k, name in enumerate(keys)))
    known = reduce(Column.__and__, (F.col(f"`{name}`").isNotNull() for name in keys))
    found = F.struct(*(F.col(f"`{name}`").alias(f"v{k}") for k, name in enumerate(values)))
    micros = lambda name: F.unix_micros(F.col(f"`{name}`").cast("timestamp")).alias("micros")

    left = rows.select(
        key.alias("key"), micros(time), known.alias("known"), F.struct(*(F.col(f"`{name}`").alias(f"c{k}") for k, name in enumerate(rows.columns))).alias("row"),
    )
    right = others.where(known & F.col(f"`{others_time}`").isNotNull()).select(key.alias("key"), micros(others_time), found.alias("found"))
    met = F.col("known") & F.col("micros").isNotNull()
    bounds = _bounds(left.where(met).select("micros").unionByName(right.select("micros")), slot_rows)

    slot = _slot(F.col("micros"), bounds).alias("slot")
    nothing = F.lit(None).cast(right.schema["found"].dataType).alias("found")
    no_row = F.lit(None).cast(left.schema["row"].dataType).alias("row")
    asking = left.where(met).select("key", slot, "micros", F.lit(True).alias("asks"), nothing, "row")
    telling = right.select("key", slot, "micros", F.lit(False).alias("asks"), "found", no_row)
    both = asking.unionByName(telling)
    if bounds:
        both = both.unionByName(_carried(asking, telling).select("key", "slot", F.lit(None).cast("long").alias("micros"), F.lit(False).alias("asks"), "found", no_row))
    # Within an instant what is told comes first; the values decide among equals. A carried value has no time and precedes all.
    through = W.partitionBy("key", "slot").orderBy(F.col("micros").asc_nulls_first(), "asks", "found").rowsBetween(W.unboundedPreceding, 0)
    joined = both.withColumn("latest", F.last("found", ignorenulls=True).over(through)).where("asks").select("row", "latest")
    unmet = left.where(~F.coalesce(met, F.lit(False))).select("row", nothing.alias("latest"))
    return joined.unionByName(unmet).select(
        *(F.col(f"row.c{k}").alias(name) for k, name in enumerate(rows.columns)),
        *(F.col(f"latest.v{k}").alias(name) for k, name in enumerate(values)),
    )


def _carried(asking: DataFrame, telling: DataFrame) -> DataFrame:
    """(key, slot, found): the last value of any earlier slot, for the slots that are asked about."""
    last = telling.groupBy("key", "slot").agg(F.max(F.struct("micros", "found")).alias("last"), F.lit(False).alias("asked"))
    asked = asking.select("key", "slot").distinct().select("key", "slot", F.lit(None).cast(last.schema["last"].dataType).alias("last"), F.lit(True).alias("asked"))
    by_slot = last.unionByName(asked).groupBy("key", "slot").agg(F.max("last").alias("last"), F.max("asked").alias("asked"))
    before = W.partitionBy("key").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    return (
        by_slot.withColumn("before", F.last("last", ignorenulls=True).over(before))
        .where(F.col("asked") & F.col("before").isNotNull()).select("key", "slot", F.col("before.found").alias("found"))
    )
