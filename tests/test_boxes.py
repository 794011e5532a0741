from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe import box_summary
from tallyframe.operators import boxes as module
from tallyframe.plans import joins
from tests.helpers import boxes, collected_boxes, plan_of

NAN, INF = float("nan"), float("inf")


@pytest.fixture(autouse=True)
def all_groups_are_large(monkeypatch):
    """Small fixtures take the way of large groups; tests of the other way say so."""
    monkeypatch.setattr(module, "SORTED_ROWS", 0)


def frame_of(spark, rows, partitions=4):
    return spark.createDataFrame(rows, "g string, v double").repartition(partitions)


def close(actual, expected):
    assert actual.keys() == expected.keys()
    for by, row in expected.items():
        assert actual[by] == pytest.approx(row, rel=1e-12, abs=1e-300), by


def test_missing_values_null_groups_and_outliers(spark):
    rows = [("a", v) for v in (1.0, 2.0, 3.0, 100.0, NAN, INF, -INF, None)]
    rows += [("b", None), ("b", NAN), (None, 4.0)]
    result = collected_boxes(box_summary(frame_of(spark, rows), "v", "g"))
    assert result == {
        "a": (4, 1.0, 1.0, 1.75, 2.5, 27.25, 3.0, 100.0, 1),
        None: (1, 4.0, 4.0, 4.0, 4.0, 4.0, 4.0, 4.0, 0),
    }


def test_columns_and_types(spark):
    result = box_summary(frame_of(spark, [("a", 1.0)]), "v", "g")
    doubles = ["min", "whisker_lo", "q1", "median", "q3", "whisker_hi", "max"]
    assert result.dtypes == [
        ("by", "string"),
        ("n", "bigint"),
        *((name, "double") for name in doubles),
        ("outliers", "bigint"),
    ]


@pytest.mark.parametrize("approx", [False, True])
def test_no_rows(spark, approx):
    empty = frame_of(spark, [])
    assert box_summary(empty, "v", "g", approx).collect() == []


def test_other_types(spark):
    frame = spark.range(101).select((F.col("id") % 2).cast("int").alias("k"), "id")
    result = collected_boxes(box_summary(frame, F.col("id") * 2, "k"))
    close(result, boxes([(i % 2, i * 2.0) for i in range(101)]))


def test_extreme_magnitudes_and_signs(spark):
    values = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 1e308, -1e308, 1.0, -1.0, 1e-5]
    rows = [("x", v) for v in values] + [("y", -v) for v in values[2:]]
    close(collected_boxes(box_summary(frame_of(spark, rows), "v", "g")), boxes(rows))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(
                st.none(),
                st.floats(-1e6, 1e6),
                st.integers(-3, 3).map(float),
                st.sampled_from([NAN, INF, -INF]),
            ),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_random_groups(spark, rows):
    actual = collected_boxes(box_summary(frame_of(spark, rows), "v", "g"))
    expected = boxes(rows)
    assert actual.keys() == expected.keys()
    for by, row in expected.items():
        # Outliers and whiskers may hinge on the last digit of a fence.
        exact = [0, 1, 7]
        assert [actual[by][i] for i in exact] == [row[i] for i in exact]
        assert [actual[by][i] for i in (3, 4, 5)] == pytest.approx(
            [row[i] for i in (3, 4, 5)], rel=1e-12, abs=1e-9
        )


def skewed_rows():
    """A third of all rows in one group, close together; heavy tails; many copies."""
    rng = random.Random(7)
    rows = [("hot", 1.0 + rng.random() * 1e-7) for _ in range(3000)]
    rows += [(f"g{i % 40}", rng.lognormvariate(0, 4) * rng.choice((-1, 1))) for i in range(4000)]
    rows += [("copies", 3.25)] * 1500 + [("copies", rng.gauss(3, 1)) for _ in range(500)]
    return rows


def test_skewed_groups(spark):
    rows = skewed_rows()
    close(collected_boxes(box_summary(frame_of(spark, rows), "v", "g")), boxes(rows))


@pytest.mark.parametrize("most", [100, 10_000])
def test_both_ways_give_the_same_digits(spark, monkeypatch, most):
    rows = skewed_rows() + [(None, v) for v in (1.5, 2.0, NAN)] + [("one", 7.25), ("none", None)]
    frame = frame_of(spark, rows)
    large = collected_boxes(box_summary(frame, "v", "g"))
    monkeypatch.setattr(module, "SORTED_ROWS", most)
    result = box_summary(frame, "v", "g")
    assert collected_boxes(result) == large
    assert result.dtypes == box_summary(frame.where("g = 'one'"), "v", "g").dtypes


def test_small_groups_take_one_exchange(spark, monkeypatch):
    monkeypatch.setattr(module, "SORTED_ROWS", 20_000)
    plan = plan_of(box_summary(frame_of(spark, skewed_rows()).repartition(3), "v", "g"))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize("cells", [7, 64])
def test_large_brackets_are_cut_again_until_they_are_small(spark, monkeypatch, cells):
    passes = []
    original = module.durable

    def counting(frame):
        passes.append(1)
        return original(frame)

    monkeypatch.setattr(module, "durable", counting)
    monkeypatch.setattr(module, "LISTED_ROWS", 5)
    monkeypatch.setattr(module, "BRACKET_CELLS", cells)
    rows = skewed_rows()
    close(collected_boxes(box_summary(frame_of(spark, rows), "v", "g")), boxes(rows))
    assert len(passes) > 3


@pytest.fixture
def only_asked_for_broadcasts(spark, monkeypatch):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = spark.conf.get(names[0])
    for name in names:
        spark.conf.set(name, "-1")
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    yield
    spark.conf.set(names[0], before)
    spark.conf.unset(names[1])


def test_group_table_too_large_to_broadcast(spark, monkeypatch, only_asked_for_broadcasts):
    monkeypatch.setattr(joins, "HOT_FRACTION", 0.1)
    rows = skewed_rows() + [(None, float(v)) for v in range(50)]
    result = box_summary(frame_of(spark, rows), "v", "g")
    plan = plan_of(result)
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    close(collected_boxes(result), boxes(rows))


def test_hot_groups_are_not_shuffled_with_or_without_a_match(
    spark, monkeypatch, only_asked_for_broadcasts
):
    monkeypatch.setattr(joins, "HOT_FRACTION", 0.2)
    rows = spark.range(900).selectExpr("if(id % 3 < 2, id % 3, id) AS by", "id * 1D AS x")
    sizes = rows.groupBy("by").count().toDF("key", "total")
    matched = sizes.where("key <> 1 AND key < 500")
    shuffled = []
    original = joins._on

    def watching(frame, groups, match=None):
        shuffled.append(frame)
        return original(frame, groups, match)

    monkeypatch.setattr(joins, "_on", watching)
    joined = joins.join_groups(rows, matched, sizes)
    assert {r[0] for r in shuffled[-1].select("by").distinct().collect()} == set(range(2, 900, 3))
    expected = [(i % 3, i) for i in range(900) if i % 3 == 0]
    expected += [(i, i) for i in range(900) if i % 3 == 2 and i < 500]
    assert sorted((r["by"], int(r["x"])) for r in joined.collect()) == sorted(expected)


def test_hot_groups_with_long_keys_are_split(spark, monkeypatch, only_asked_for_broadcasts):
    monkeypatch.setattr(joins, "HOT_FRACTION", 0.2)
    long = "k" * 2000
    rows = spark.range(0, 6000, 1, 4).selectExpr(f"if(id % 3 = 0, '{long}', 'g' || id % 50) AS by", "id * 1D AS x")
    sizes = rows.groupBy("by").count().toDF("key", "total")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        joined = joins.join_groups(rows, sizes.select("key"), sizes)
        parts = joined.where("length(by) > 100").groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 6000
        assert len(parts) >= 32 and sum(r["count"] for r in parts) == 2000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_boxes_of_long_keys(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    rows = [("k" * 2000, float(v % 17)) for v in range(300)] + [("s", 1.0), ("s", 2.0)]
    close(collected_boxes(box_summary(frame_of(spark, rows), "v", "g")), boxes(rows))


def test_small_group_tables_leave_the_rows_where_they_are(spark):
    result = box_summary(frame_of(spark, skewed_rows()), "v", "g")
    plan = plan_of(result)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "percentile" not in plan


def test_approximate_ranks(spark):
    frame = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("v"),
    )
    exact = collected_boxes(box_summary(frame, "v", "g"))
    approximate = collected_boxes(box_summary(frame, "v", "g", approx=True))
    assert approximate.keys() == exact.keys()
    for by, row in approximate.items():
        assert row[0] == exact[by][0] and row[1] == exact[by][1] and row[7] == exact[by][7]
        for position, p in ((3, 0.25), (4, 0.5), (5, 0.75)):
            group = F.col("g") == by
            below = frame.where(group & (F.col("v") <= row[position])).count()
            assert abs(below / row[0] - p) <= module.RANK_ERROR + 1 / row[0]
