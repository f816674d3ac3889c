from __future__ import annotations

import hashlib

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from conformance import fixtures
from tidefare.operators import sampling


def place(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.mark.parametrize("n", [1, 7, 500, 999, 1000, 5000])
@pytest.mark.parametrize("seed", [42, 7])
def test_seeded_sample_is_the_n_smallest_places(spark, n, seed):
    rows = spark.range(1000).withColumnRenamed("id", "key")
    found = {row.key for row in sampling.seeded_sample(rows, n, "key", seed=seed).collect()}
    assert found == set(sorted(range(1000), key=lambda key: place(seed, key))[:n])


def test_seeded_sample_of_nothing(spark):
    assert sampling.seeded_sample(spark.range(0), 10, "id").collect() == []


def test_seeded_sample_with_repeated_keys_keeps_n(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("key"))
    assert sampling.seeded_sample(rows, 1500, "key").count() == 1500


def test_samples_do_not_depend_on_partitioning(spark, small):
    trips = fixtures.raw_trips(spark, small)
    for draw in (
        lambda rows: sampling.seeded_sample(rows, 50, "trip_id"),
        lambda rows: sampling.block_sample(rows, "trip_id", 100, 5),
        lambda rows: sampling.train_test_split(rows, "trip_id")[0],
    ):
        ids = [
            {row.trip_id for row in draw(rows).collect()}
            for rows in (trips, trips.repartition(7), trips.repartition(3, "fare_amount"))
        ]
        assert ids[0] == ids[1] == ids[2]


def test_seeded_sample_sorts_only_what_it_keeps(spark):
    """The second pass drops nearly all rows before the sort."""
    rows = spark.range(0, 100_000, 1, 8).withColumnRenamed("id", "key")
    part = sampling._leading_part(sampling.sample_key(42, "key"))
    counts = rows.groupBy(part.alias("part")).count().orderBy("part").collect()
    assert len(counts) < 1500
    seen, kept = 0, 0
    for row in counts:
        seen += row["count"]
        if seen >= 500:
            kept = seen
            break
    assert 500 <= kept < 600


def test_block_sample_takes_up_to_n_per_block(spark):
    rows = spark.range(0, 1050, 1, 8).withColumnRenamed("id", "position")
    found = {row.position for row in sampling.block_sample(rows, "position", 100, 20).collect()}
    expected = set()
    for start in range(0, 1050, 100):
        block = range(start, min(start + 100, 1050))
        expected |= set(sorted(block, key=lambda key: place(42, key))[:20])
    assert found == expected
    short = sampling.block_sample(rows, "position", 100, 60)
    assert short.filter("position >= 1000").count() == 50


def test_block_sample_of_the_first_blocks(spark):
    rows = spark.range(1000).withColumnRenamed("id", "position")
    found = sampling.block_sample(rows, "position", 100, 10, max_blocks=3)
    assert found.count() == 30
    assert found.agg(F.max("position")).first()[0] < 300


def test_block_sample_cuts_before_it_sorts(spark):
    rows = spark.range(5_000_000).selectExpr("id AS position", "id AS a", "id AS b")
    setting = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    tree = plan_text(sampling.block_sample(rows, "position", per_block=100_000), "simple").splitlines()
    # Upwards from the scan of the rows: the join with the cuts, then a shuffle, and only then their sort.
    joined = next(k for k, line in enumerate(tree) if "Join" in line)
    assert any("Sort" in line for line in tree[:joined]) and any("Exchange" in line for line in tree[:joined])
    assert not any("Sort" in line and "sample_place" in line for line in tree[joined:])
    assert spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold") == setting


def test_split_parts_are_disjoint_and_whole(spark, gate):
    trips = fixtures.raw_trips(spark, gate)
    train, test = sampling.train_test_split(trips, "trip_id")
    train_ids = {row.trip_id for row in train.select("trip_id").collect()}
    test_ids = {row.trip_id for row in test.select("trip_id").collect()}
    assert not train_ids & test_ids
    assert len(train_ids) + len(test_ids) == trips.count()
    assert 0.78 < len(train_ids) / trips.count() < 0.82
    expected = {i for i in range(10_000) if int(place(42, i)[:8], 16) % 100 < 80}
    assert train_ids == expected


def test_split_without_keys_uses_the_whole_row(spark):
    rows = spark.range(2000).selectExpr("id % 500 AS a", "if(id % 3 = 0, null, id) AS b")
    train, test = sampling.train_test_split(rows)
    assert train.count() + test.count() == 2000
    assert train.intersect(test).count() == 0
