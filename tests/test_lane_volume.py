"""What lane matching and relations exchange: narrow rows, about as many as there are lanes and ticks, and no unfolded pairs."""

import os

import pytest
from pyspark.sql import functions as F

from clipspans.operators import lanes
from clipspans.plans import inputs, registry

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
SCHEMA = "map_id string, lane_id string, center array<struct<x: double, y: double>>, next array<string>, left array<string>, right array<string>"
PIECES, TICKS = 20, 30


def city(clips):
    """Per clip a map of five lanes in pieces, of which its ticks drive along two."""
    name = lambda j, i: f"L{j}_{i}"
    maps = [
        (f"c{c}", name(j, i), [(10.0 * i, 3.5 * j), (10.0 * i + 10, 3.5 * j)], [name(j, i + 1)] if i < PIECES - 1 else [], [name(j + 1, i)] if j < 2 else [], [name(j - 1, i)] if j > -2 else [])
        for c in range(clips) for j in range(-2, 3) for i in range(PIECES)
    ]
    ticks = [(f"c{c}", "ego", t, f"c{c}", 0.8 * t, 3.5 * min(max(t - 8, 0), 10) / 10, 0.0) for c in range(clips) for t in range(TICKS)]
    return maps, ticks


def shuffled(spark, made):
    """Rows of what ``made`` returns, and how many rows all exchanges wrote for it."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (lambda x: [x.apply(i) for i in range(x.size())])(store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None))}
    before = stages()
    rows = made().collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return rows, sum(n for k, n in stages().items() if k not in before)


def test_exchanged_rows_grow_with_lanes_and_ticks(spark):
    n = 40
    maps, ticks = city(n)
    maps = spark.createDataFrame(maps, SCHEMA)
    poses = spark.createDataFrame(ticks, "clip_id string, agent_id string, tick int, map_id string, x double, y double, heading double")
    matched, wrote = shuffled(spark, lambda: lanes.match_lanes(poses, maps))
    # each tick and each lane in the cells that it meets; pairs of ticks and pieces would be some 300 more to a clip
    assert len(matched) == n * TICKS and wrote <= n * (TICKS + 5 * PIECES * 2.5)
    stored = spark.createDataFrame(matched, lanes.match_lanes(poses, maps).schema)
    decided, wrote = shuffled(spark, lambda: lanes.label_lane_ticks(None, maps, matched=stored, sets=False))
    # the lanes, for the steps ahead and for what lies beside them; few rows for the lanes that ticks are on; the ticks
    assert len(decided) == n * TICKS and {r.lane_decision for r in decided} == {"keep_lane", "left_lane_change"}
    assert wrote <= n * (2 * 5 * PIECES + 3 * TICKS + 150)


def test_neighbours_of_some_lanes_are_those_of_all(spark):
    maps = spark.createDataFrame(city(2)[0], SCHEMA)
    every = {(r.map_id, r.lane_id): r for r in lanes.lane_neighbours(maps).collect()}
    some = lanes.lane_neighbours(maps, of=maps.where("lane_id like '%_1_'").select("map_id", "lane_id").union(maps.select("map_id", F.lit("gone")))).collect()
    assert len(every) == 200 and len(some) == 102
    assert all(r == every[r.map_id, r.lane_id] for r in some if r.lane_id != "gone")
    assert all(r.next_lanes == r.left_lanes == r.right_lanes == [] for r in some if r.lane_id == "gone")


def test_a_look_ahead_made_before_or_after_relations_is_the_same(spark):
    maps, ticks = city(2)
    maps = spark.createDataFrame(maps, SCHEMA)
    poses = spark.createDataFrame(ticks, "clip_id string, agent_id string, tick int, map_id string, x double, y double, heading double")
    matched = lanes.match_lanes(poses, maps)
    early, late = lanes.temporal_vote(lanes.lane_relations(lanes.look_ahead(matched), maps)), lanes.temporal_vote(lanes.lane_relations(matched, maps))
    assert early.columns == late.columns
    assert sorted(map(str, early.collect())) == sorted(map(str, late.collect()))
    wide, narrow = lanes.label_lane_ticks(poses, maps), lanes.label_lane_ticks(poses, maps, sets=False)
    assert set(wide.columns) - set(narrow.columns) == set(lanes.SETS)
    assert sorted(map(str, wide.select(*narrow.columns).collect())) == sorted(map(str, narrow.collect()))


@tables
def test_maps_are_made_in_all_partitions(spark):
    """Their clips are few bytes, which would be coalesced into one task."""
    maps = inputs.lanes(spark, SF)
    assert maps.rdd.getNumPartitions() == 4 and maps.select(F.spark_partition_id()).distinct().count() > 1


@tables
@pytest.mark.parametrize("name", ["m_lane_decisions", "g4_segment_lane", "g8_clean_lane", "m6_temporal_vote"])
def test_queries_exchange_few_rows(spark, name):
    ticks = inputs.lane_ticks(spark, SF).count()
    rows, wrote = shuffled(spark, lambda: registry.queries()[name](spark, SF))
    assert rows and wrote <= 8 * (ticks + inputs.lanes(spark, SF).count())
