"""Quantiles of measures without levels: mergeable sketches per cell, and exact selection.

*Sketches.* A KLL sketch of each measure is kept for every trip cell (day, hour, weekend, surge level): at
most 1,344 rows of a few kilobytes, made in one partial-aggregated pass. Any dashboard filter on cell
keys merges the sketches of its cells and never scans trips again. A sketch of size `SKETCH_SIZE` misses a
rank by less than `RANK_ERROR` of the rows, in all but about one of a hundred cases.

*Exact selection.* Each pass keeps, for every fraction, an interval that holds the wanted rank, counts what
lies below and inside, and takes the interval's sketch; the sketch proposes a narrower one, which the next
pass confirms by counting or gives up. Only counts and sketches travel. Once an interval holds at most
`FEW_VALUES` distinct values or rows, these alone are sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidefare.operators.cells import MEASURES
from tidefare.operators.local import rows_of

CELL_KEYS = ("day_of_week", "hour", "is_weekend", "surge_multiplier")
FRACTIONS = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}
SKETCH_SIZE = 400
#: What a sketch of that size may miss a rank by, as a part of all rows; sketches that were merged included.
RANK_ERROR = 0.0133
FEW_VALUES = 100_000


def measure_sketches(trips: DataFrame, measures: Mapping[str, str] = MEASURES, size: int = SKETCH_SIZE) -> DataFrame:
    """One row per trip cell: its keys and a sketch of each measure, under the measure's name."""
    sketches = [F.kll_sketch_agg_double(F.col(column), size).alias(name) for name, column in measures.items()]
    return trips.groupBy(*CELL_KEYS).agg(*sketches)


def sketched_quantiles(sketches: DataFrame, fractions: Mapping[str, float] = FRACTIONS, measures: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """(measure, a column for each fraction) over all cells given; no rows for measures without values."""
    merged = sketches.agg(*(F.kll_merge_agg_double(name).alias(name) for name in measures))
    one_each = merged.select(F.inline(F.array(*(F.struct(F.lit(name).alias("measure"), F.col(name).alias("sketch")) for name in measures))))
    some = one_each.where(F.kll_sketch_get_n_double("sketch") > 0)
    return some.select("measure", *(F.kll_sketch_get_quantile_double("sketch", F.lit(at)).alias(name) for name, at in fractions.items()))


def _wanted(rows: int, fraction: float) -> int:
    """The rank, from 1, of the lowest value that at least this part of the rows does not exceed."""
    whole = int(fraction * rows)
    return max(1, whole if whole >= fraction * rows else whole + 1)


def exact_quantiles(
    trips: DataFrame, fractions: Mapping[str, float] = FRACTIONS, measures: Mapping[str, str] = MEASURES, few: int = FEW_VALUES, size: int = SKETCH_SIZE
) -> DataFrame:
    """(measure, a column for each fraction): the lowest value that at least that part of the known values does not exceed.

    Nulls are left out; a measure without values has no row. Reads the measures' columns once a pass.
    """
    values = trips.select(*(F.col(column).cast("double").alias(name) for name, column in measures.items()))
    first = values.agg(*(
        value.alias(f"{name}_{what}") for name in measures
        for what, value in (("n", F.count(name)), ("least", F.min(name)), ("most", F.max(name)), ("sketch", _proposal_sketch(F.col(name), size)))
    ))
    bounds = _with_points(first, [(name, name) for name in measures], size).first()
    # For each (measure, fraction): the interval that is known to hold the rank, and one to try.
    open_: dict[tuple[str, str], dict] = {}
    for name in measures:
        rows = bounds[f"{name}_n"]
        for label, at in fractions.items() if rows else ():
            spot = {"rank": _wanted(rows, at), "below": 0, "inside": rows, "low": bounds[f"{name}_least"], "high": bounds[f"{name}_most"], "error": 2 * RANK_ERROR}
            spot["try"] = _narrower(spot, bounds[f"{name}_points"])
            open_[name, label] = spot
    while any(spot["try"] for spot in open_.values()):
        trying = {key: spot for key, spot in open_.items() if spot["try"]}
        counted = _counted(values, trying, size).first()
        for k, spot in enumerate(trying.values()):
            below, inside, points = counted[f"below_{k}"], counted[f"inside_{k}"], counted[f"points_{k}"]
            if below < spot["rank"] <= below + inside:
                spot["low"], spot["high"] = spot["try"]
                spot["below"], spot["inside"], spot["error"] = below, inside, 2 * RANK_ERROR
                spot["try"] = _narrower(spot, points) if inside > few else None
            else:
                # The sketch missed: a wider interval, at last the known one itself.
                spot["error"] *= 2
                spot["try"] = _narrower(spot, spot["points"])
    return _selected(values, open_, measures, fractions)


#: The quantiles a sketch is asked for, to propose the next interval from.
POINTS = [k / 1000 for k in range(1001)]


def _proposal_sketch(value: Column, size: int) -> Column:
    return F.kll_sketch_agg_double(value, size)


def _with_points(row: DataFrame, names: Sequence[tuple[str, str]], size: int) -> DataFrame:
    """The one row with each sketch read out at `POINTS`; null where it is empty."""
    listed = F.array(*(F.lit(at) for at in POINTS))
    return row.withColumns({
        f"{target}_points": F.when(F.kll_sketch_get_n_double(f"{source}_sketch") > 0, F.kll_sketch_get_quantile_double(f"{source}_sketch", listed))
        for source, target in names
    })


def _narrower(spot: dict, points: list[float] | None) -> tuple[float, float] | None:
    """The sketch's values around the wanted rank; None if that narrows nothing."""
    spot["points"] = points
    if not points or spot["inside"] == 0:
        return None
    at = (spot["rank"] - spot["below"]) / spot["inside"]
    last = len(points) - 1
    low = max(0, int((at - spot["error"]) * last))
    high = min(last, int((at + spot["error"]) * last) + 1)
    found = (spot["low"] if low == 0 else points[low], spot["high"] if high == last else points[high])
    return None if found == (spot["low"], spot["high"]) else found


def _counted(values: DataFrame, trying: Mapping[tuple[str, str], dict], size: int) -> DataFrame:
    """For each interval to try: rows below it, rows inside, and the inside's sketch at `POINTS`."""
    aggregates = []
    for k, ((name, _), spot) in enumerate(trying.items()):
        low, high = (F.lit(bound) for bound in spot["try"])
        inside = F.col(name).between(low, high)
        aggregates += [
            F.count_if(F.col(name) < low).alias(f"below_{k}"), F.count_if(inside).alias(f"inside_{k}"),
            _proposal_sketch(F.when(inside, F.col(name)), size).alias(f"{k}_sketch"),
        ]
    listed = F.array(*(F.lit(at) for at in POINTS))
    row = values.agg(*aggregates)
    return row.withColumns({
        f"points_{k}": F.when(F.kll_sketch_get_n_double(f"{k}_sketch") > 0, F.kll_sketch_get_quantile_double(f"{k}_sketch", listed)) for k in range(len(trying))
    })


def _selected(values: DataFrame, spots: Mapping[tuple[str, str], dict], measures: Mapping[str, str], fractions: Mapping[str, float]) -> DataFrame:
    """The wanted rows of the intervals: one filtered pass, counted by value, and a running count for each interval."""
    if not spots:
        fields = "".join(f", {label}: double" for label in fractions)
        return rows_of(values.sparkSession, f"measure: string{fields}", [])
    wanted = [
        F.when(F.col(name).between(spot["low"], spot["high"]), F.struct(
            F.lit(name).alias("measure"), F.lit(label).alias("label"), F.lit(spot["rank"] - spot["below"]).cast("long").alias("rank"), F.col(name).alias("value"),
        ))
        for (name, label), spot in spots.items()
    ]
    counted = values.select(F.inline(F.array_compact(F.array(*wanted)))).groupBy("measure", "label", "rank", "value").agg(F.count(F.lit(1)).alias("n"))
    # At most `FEW_VALUES` rows, or one value, for each interval.
    through = W.partitionBy("measure", "label").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    reached = counted.withColumn("seen", F.sum("n").over(through)).where(F.col("seen") >= F.col("rank"))
    chosen = reached.groupBy("measure", "label").agg(F.min("value").alias("value"))
    return chosen.groupBy("measure").agg(*(F.max(F.when(F.col("label") == label, F.col("value"))).alias(label) for label in fractions))
