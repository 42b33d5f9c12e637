"""What the plans look like, and what happens when one key holds much of the data."""

from __future__ import annotations

import re

import pytest
from conftest import FOLDER, rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from __spark_entry__ import queries
from almanac.operators import bars, classes, counts
from almanac.operators.hot_joins import heavy_keys, spread_join
from almanac.operators.running import numbered
from almanac.plans import oracles
from almanac.sources import table

UNHINTED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(oracles()))
def test_no_cross_join_and_no_python_worker(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["weekly_lags", "dense_key_year_counts", "label_features", "group_propensity"])
def test_results_hold_without_any_broadcast(spark, conf, name):
    wanted = rows_of(queries()[name](spark, FOLDER))
    conf(**{k.replace(".", "__"): v for k, v in UNHINTED.items()})
    frame = queries()[name](spark, FOLDER)
    assert rows_of(frame) == wanted
    assert "BroadcastExchange" not in plan_of(frame)


def test_scans_read_only_the_columns_they_need(spark):
    plan = plan_of(queries()["seasonal_average"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", ["recent_topk", "welch_t", "arrest_profile_hour"])
def test_filters_reach_the_scan(spark, name):
    plan = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    pushed = {
        "recent_topk": r"GreaterThanOrEqual\(o_orderdate",
        "welch_t": r"LessThan\(o_orderdate",
        "arrest_profile_hour": r"EqualTo\(event_type,purchase\)",
    }[name]
    assert re.search(r"PushedFilters: \[[^\]]*" + pushed, plan)


def test_bars_are_shuffled_once_for_both_sides_of_their_join(spark):
    frame = queries()["bar_group_features"](spark, FOLDER)
    frame.collect()
    assert "ReusedExchange" in plan_of(frame)


def test_folds_are_counted_in_one_scan(spark):
    assert plan_of(queries()["walk_forward_folds"](spark, FOLDER)).count("FileScan") == 1


def test_counting_below_the_join_equals_counting_above_it(spark):
    """One customer holds a third of the orders and still sends one row per week into the join."""
    orders = spark.range(9000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("cust"),
        F.timestamp_seconds(1_500_000_000 + F.col("id") * 5000).alias("time"),
    )
    customers = spark.range(50).select(F.col("id").alias("cust"), (F.col("id") % 4).alias("beat"))
    below = counts.weekly_counts(orders, ["cust"], "id", "time")
    weeks = orders.select(F.year("time"), F.weekofyear("time")).distinct().count()
    assert below.filter("cust = 7").count() <= weeks
    rolled = counts.sum_counts(below.join(customers, "cust"), ["beat", "year", "week"], ["crimes"])
    direct = counts.weekly_counts(orders.join(customers, "cust"), ["beat"], "id", "time")
    assert rows_of(rolled, *direct.columns) == rows_of(direct, *direct.columns)


def test_a_large_supplier_is_numbered_in_slices(spark):
    rows = table(spark, FOLDER, "lineitem", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    hot = rows.withColumn("trade", F.when(F.col("l_orderkey") % 3 == 0, -1).otherwise(F.col("l_suppkey")))
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    window = Window.partitionBy("trade").orderBy(*order)
    wanted = hot.withColumn("bar_num", F.row_number().over(window).cast("bigint"))
    sliced = numbered(hot, "bar_num", ("trade",), order)
    assert rows_of(sliced, *wanted.columns) == rows_of(wanted, *wanted.columns)
    assert sliced.filter("trade = -1").agg(F.max("bar_num"), F.countDistinct("bar_num")).head()[:] == (
        hot.filter("trade = -1").count(),
    ) * 2


def test_a_hot_truck_is_split_by_the_join(spark, conf):
    """A third of the inspections are of one truck; the join splits it and loses no row."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10000",
    )
    i = F.col("id")
    inspections = spark.range(0, 60000, 1, 8).select(
        F.when(i % 3 == 0, "hot").otherwise((i % 500).cast("string")).alias("truck_number_one"),
        F.when(i % 2 == 0, "b").alias("basic"), F.sha2(i.cast("string"), 256).alias("time_weight"),
    )
    fleet = spark.range(500).select(F.col("id").cast("string").alias("truck_number")).unionByName(
        spark.range(1).select(F.lit("hot").alias("truck_number"))
    ).select(
        "truck_number", F.lit("1").alias("purchase_price"), F.lit("2").alias("model_year"), F.lit("s").alias("state"),
        F.lit("m").alias("manufacturer"),
    )
    frame = classes.label_features(inspections, fleet, "truck_number_one", "truck_number")
    assert len(frame.collect()) == 60000
    assert "SortMergeJoin(skew=true)" in plan_of(frame)


def test_results_do_not_depend_on_partitioning(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 40).alias("trade_id"), (F.floor(F.col("id") / 40) + 1).alias("bar_num"),
        F.round(F.rand(1) * 100).alias("profit"),
    ).cache()
    wanted = rows_of(bars.with_previous_group(rows))
    for other in (rows.repartition(1), rows.repartition(13), rows.repartition(7, "bar_num")):
        found = bars.with_previous_group(other)
        assert [r[:4] for r in rows_of(found)] == [r[:4] for r in wanted]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_spread_join_leaves_no_task_with_twice_the_mean(spark, conf, how):
    """A third of the facts have one key; adaptive execution is off, so the salts are all that splits it."""
    conf(
        spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
    )
    i = F.col("id")
    facts = spark.range(0, 90_000, 1, 6).select(
        i, F.when(i % 3 == 0, 7).when(i % 50 == 1, None).otherwise(i % 4000).alias("k"), F.lit("same").alias("fact")
    )
    dimension = spark.range(3500).select(F.col("id").alias("d"), (F.col("id") * 2).alias("twice"))
    joined = spread_join(facts, dimension, ["k"], ["d"], how)
    wanted = facts.join(dimension, F.col("k") == F.col("d"), how)
    assert rows_of(joined) == rows_of(wanted)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * sum(sizes) / 16
    plain = [r["count"] for r in wanted.groupBy(F.spark_partition_id()).count().collect()]
    assert max(plain) > 4 * sum(plain) / 16


def test_a_spread_join_on_two_keys_and_repeated_dimension_rows(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    i = F.col("id")
    facts = spark.range(3000).select(F.when(i % 2 == 0, "hot").otherwise((i % 9).cast("string")).alias("a"), (i % 2).alias("b"), i.alias("v"))
    dimension = spark.createDataFrame([("hot", 0, 1), ("hot", 0, 2), ("3", 1, 3), (None, 1, 4)], "c string, d long, w int")
    joined = spread_join(facts, dimension, ["a", "b"], ["c", "d"], "left")
    wanted = facts.join(dimension, (F.col("a") == F.col("c")) & (F.col("b") == F.col("d")), "left")
    assert rows_of(joined) == rows_of(wanted)
    assert not spread_join(facts.limit(0), dimension, ["a"], ["c"]).collect()
    with pytest.raises(ValueError):
        spread_join(facts, dimension, ["a"], ["c"], "right")


@pytest.mark.parametrize("share", [0.3, 0.02, 0.002])
def test_no_heavy_key_is_missed(spark, share):
    """Skewed keys, and as many that occur once, over several tasks whose summaries are merged."""
    i = F.col("id")
    rows = spark.range(0, 60_000, 1, 7).select(
        F.when(i % 3 == 0, -1).when(i % 2 == 0, F.floor(F.sqrt(i % 40_000))).when(i % 11 == 0, None).otherwise(1_000_000 + i).alias("k")
    )
    known = rows.filter("k IS NOT NULL")
    least = share * known.count()
    wanted = rows_of(known.groupBy("k").agg(F.count("*").alias("n")).filter(F.col("n") >= least), "k", "n")
    assert rows_of(heavy_keys(rows, ["k"], share), "k", "n") == wanted and wanted
