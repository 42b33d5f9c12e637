"""Small hand-made frames for the semantics that are easy to get wrong."""

from __future__ import annotations

import datetime
import math
import random

import numpy as np
import pytest
from conftest import rows_of
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Window
from pyspark.sql import functions as F

from almanac.functions import percentage_error, with_calendar
from almanac.operators import accuracy, bars, classes, contrasts, correlation, counts, density, folds, recency, running


def test_seasonal_average_counts_ids_once_and_only_years_present(spark):
    rows = spark.createDataFrame(
        [("a", 2018, 1), ("a", 2018, 1), ("b", 2018, 1), ("c", 2019, 1), ("d", 2019, 2)],
        "id string, year int, month int",
    )
    result = counts.seasonal_average(rows, "id", F.col("year"), F.col("month"))
    assert rows_of(result, "month", "avg_count") == [(1, 1.5), (2, 1.0)]


def test_week_of_new_year_keeps_the_calendar_year(spark):
    rows = spark.createDataFrame([(datetime.datetime(2016, 1, 1, 5),)], "time timestamp")
    parts = ("year", "week", "weekday", "hour")
    assert rows_of(with_calendar(rows, "time", *parts), *parts) == [(2016, 53, 6, 5)]


def test_calendar_profiles_agree_with_single_ones(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 7 != 0, F.col("id")).alias("id"),
        F.timestamp_seconds(F.col("id") * 7919).alias("time"),
    )
    parts = ("month", "weekday", "hour")
    together = rows_of(counts.calendar_profiles(rows, "id", "time", parts), "part", "value", "n")
    single = [(p, *r) for p in parts for r in rows_of(counts.calendar_profile(rows, "id", "time", p), p, "n")]
    assert together == sorted(single)


@pytest.mark.parametrize("kind", ["int", "timestamp", "timestamp_ntz", "date"])
def test_recent_years_are_inclusive(spark, kind):
    rows = spark.createDataFrame([(y, f"{y}-01-01 00:00:00") for y in range(2010, 2020)], "y int, t string")
    rows = rows.withColumn("when", F.col("y") if kind == "int" else F.col("t").cast(kind))
    assert [r[0] for r in rows_of(recency.recent_years(rows, "when", 3), "y")] == [2017, 2018, 2019]


def test_top_keys_break_ties_by_key(spark):
    rows = spark.createDataFrame([(k,) for k in "bbaacdd"], "k string")
    assert [tuple(r) for r in recency.top_keys(rows, "k", 3).collect()] == [("a", 2), ("b", 2), ("d", 2)]
    weighted = spark.createDataFrame([("a", 5), ("a", 6), ("b", 12)], "k string, n bigint")
    assert [tuple(r) for r in recency.top_keys(weighted, "k", 1, F.col("n")).collect()] == [("b", 12)]


def _vectors(spark, data, years=5):
    rows = spark.createDataFrame(data, "beat string, year int, n bigint")
    latest = recency.latest_year(rows, "year")
    return density.year_vectors(rows, "beat", "year", F.col("n"), latest, years), latest


def test_dense_counts_know_all_keys_and_fill_gaps(spark):
    vectors, latest = _vectors(spark, [("old", 2001, 9), ("x", 2018, 2), ("x", 2018, 3), ("x", 2020, 4)], 3)
    assert rows_of(density.dense_counts(vectors, "beat", latest, 3), "beat", "year", "n") == [
        ("old", 2018, 0), ("old", 2019, 0), ("old", 2020, 0), ("x", 2018, 5), ("x", 2019, 0), ("x", 2020, 4),
    ]


def test_correlation_of_a_constant_series_is_zero(spark):
    data = [("flat", y, 7) for y in range(2016, 2021)] + [("up", y, y - 2015) for y in range(2016, 2021)]
    data += [("down", y, 2021 - y) for y in range(2016, 2021)]
    vectors, _ = _vectors(spark, data)
    found = {(r.key1, r.key2): r.corr for r in correlation.pairwise_correlation(vectors, "beat", 5).collect()}
    assert found[("flat", "up")] == found[("down", "flat")] == 0.0
    assert math.isclose(found[("down", "up")], -1.0)


@pytest.mark.parametrize("blocks", [1, 3, 16])
def test_every_pair_appears_once_and_agrees_with_the_dense_matrix(spark, blocks):
    random.seed(blocks)
    keys = [f"{i:02d}" for i in range(23)]
    data = [(k, y, random.randint(0, 50)) for k in keys for y in range(2016, 2021)]
    vectors, _ = _vectors(spark, data)
    pairs = correlation.pairwise_correlation(vectors, "beat", 5, blocks=blocks)
    found = [tuple(r) for r in pairs.collect()]
    assert len(found) == len({(a, b) for a, b, _ in found}) == 23 * 22 // 2
    assert all(a < b for a, b, _ in found)
    strengths = [abs(c) for _, _, c in found]
    assert strengths == sorted(strengths, reverse=True)
    by_year = spark.createDataFrame(
        [tuple(float(n) for k in keys for kk, yy, n in data if kk == k and yy == y) for y in range(2016, 2021)], keys
    )
    matrix = Correlation.corr(VectorAssembler(inputCols=keys, outputCol="v").transform(by_year), "v").head()[0]
    for a, b, value in found:
        assert math.isclose(value, matrix[keys.index(a), keys.index(b)], abs_tol=1e-9)


def _cosines(spark, seed, n):
    """Vectors in a few directions with copies, opposites and constant ones, and the correlation of all pairs."""
    random.seed(seed)
    kinds = [[random.randint(0, 400) for _ in range(5)] for _ in range(12)]
    data = []
    for i in range(n):
        kind = random.choice(kinds)
        scale = random.choice([1, 1, 2, -1])
        counts = [1000 + scale * x + random.choice([0, 0, random.randint(-60, 60)]) for x in kind]
        data.append((f"k{i:04d}", [7] * 5 if i % 40 == 0 else counts))
    centred = np.array([5 * np.array(c) - sum(c) for _, c in data], float)
    length = np.sqrt((centred**2).sum(1))
    unit = np.divide(centred, length[:, None], where=length[:, None] > 0, out=np.zeros_like(centred))
    return spark.createDataFrame(data, "beat string, counts array<bigint>"), [k for k, _ in data], unit @ unit.T


def test_only_possible_pairs_are_formed_for_a_limit(spark):
    vectors, keys, corr = _cosines(spark, 3, 500)
    for least in (0.95, 0.999):
        pairs = correlation.pairwise_correlation(vectors, "beat", 5, least=least)
        found = {(r.key1, r.key2): r.corr for r in pairs.collect()}
        wanted = {
            (keys[i], keys[j]): corr[i, j] for i in range(500) for j in range(i + 1, 500) if abs(corr[i, j]) >= least
        }
        assert found == pytest.approx(wanted, abs=1e-9) and min(found.values()) < 0 < max(found.values())
        units = correlation.unit_vectors(vectors, "beat", 5)
        formed = correlation.candidate_pairs(units, "beat", 5, least=least).count()
        assert len(wanted) <= formed < 0.35 * 500 * 499 / 2
        one = correlation.candidate_pairs(units, "beat", 5, least=least, cells=1).count()
        assert formed < one  # without pivots every pair is looked at, either way round


@pytest.mark.parametrize("years, share", [(3, 0.1), (5, 0.005), (7, 0.005)])
def test_a_limit_forms_few_pairs_of_many_directions(spark, years, share):
    """Evenly spread vectors, some of them opposite: a thousandth of all pairs is formed at five years, and none is lost."""
    x = np.random.default_rng(years).integers(0, 1000, (1000, years))
    x[::50] = 2000 - x[1::50]
    vectors = spark.createDataFrame([(i, [int(n) for n in row]) for i, row in enumerate(x)], "beat int, counts array<bigint>")
    centred = years * x - x.sum(1)[:, None]
    unit = centred / np.sqrt((centred**2).sum(1))[:, None]
    corr = unit @ unit.T
    wanted = {(i, j): corr[i, j] for i, j in np.argwhere(np.triu(np.abs(corr) >= 0.999, 1))}
    formed = correlation.candidate_pairs(correlation.unit_vectors(vectors, "beat", years), "beat", years, least=0.999)
    assert len(wanted) <= formed.count() < share * 1000 * 999 / 2
    pairs = correlation.pairwise_correlation(vectors, "beat", years, least=0.999).collect()
    assert len(pairs) == len(wanted) and min(wanted.values()) < 0
    assert {(r.key1, r.key2): r.corr for r in pairs} == pytest.approx(wanted, abs=1e-9)


def test_wanted_keys_do_not_pair_the_others(spark):
    vectors, keys, corr = _cosines(spark, 4, 300)
    few = spark.createDataFrame([("k0001",), ("k0002",), ("k0002",), ("none",)], "beat string")
    units = correlation.unit_vectors(vectors, "beat", 5)
    assert correlation.candidate_pairs(units, "beat", 5, few).count() == 299 + 298
    found = {(r.key1, r.key2) for r in correlation.pairwise_correlation(vectors, "beat", 5, few, 0.9).collect()}
    assert found == {
        (keys[i], keys[j]) for i in range(300) for j in range(i + 1, 300)
        if {i, j} & {1, 2} and abs(corr[i, j]) >= 0.9
    }


def test_crowded_cells_are_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(correlation, "BLOCK_KEYS", 10)
    monkeypatch.setattr(correlation, "VISITORS", 40)
    vectors, keys, corr = _cosines(spark, 5, 200)
    same = vectors.withColumn("counts", F.when(F.col("beat") < "k0070", F.array(*map(F.lit, (1, 2, 3, 4, 9)))).otherwise(F.col("counts")))
    everything = correlation.pairwise_correlation(same, "beat", 5)
    assert everything.count() == everything.select("key1", "key2").distinct().count() == 200 * 199 // 2
    assert correlation.pairwise_correlation(same, "beat", 5, least=0.99).filter("key2 < 'k0070'").count() == 70 * 69 // 2
    none = vectors.limit(0)
    assert not correlation.pairwise_correlation(none, "beat", 5).collect()


@pytest.mark.parametrize("most, ranges", [(1 << 24, 128), (300, 7)])
def test_a_limit_gives_the_strongest_of_all_pairs_in_order(spark, monkeypatch, most, ranges):
    """To the last digit and in the same order, however the result is cut; pairs of equal strength go either way."""
    monkeypatch.setattr(correlation, "PART_PAIRS", most)
    monkeypatch.setattr(correlation, "MOST_RANGES", ranges)
    vectors, keys, _ = _cosines(spark, 6, 150)
    equal = F.when(F.col("beat") < "k0030", F.array(*map(F.lit, (1, 2, 3, 4, 9)))).when(F.col("beat") < "k0045", F.array(*map(F.lit, (9, 8, 7, 6, 1))))
    vectors = vectors.withColumn("counts", F.coalesce(equal, "counts"))
    everything = [tuple(r) for r in correlation.pairwise_correlation(vectors, "beat", 5).collect()]
    strong = [p for p in everything if abs(p[2]) >= 0.99]
    assert [tuple(r) for r in correlation.pairwise_correlation(vectors, "beat", 5, least=0.99).collect()] == strong
    assert {c for *_, c in strong if abs(c) == abs(strong[0][2])} == {strong[0][2], -strong[0][2]}
    few = spark.createDataFrame([("k0003",), ("k0100",), ("k0100",), ("none",)], "beat string")
    of_few = [tuple(r) for r in correlation.pairwise_correlation(vectors, "beat", 5, few, 0.99, digits=4).collect()]
    assert of_few == [(a, b, round(c, 4)) for a, b, c in strong if {a, b} & {"k0003", "k0100"}]


def test_pairs_of_equal_series_are_not_written(spark, monkeypatch):
    """1,200 keys of three series, two of them opposite: what is written is short, the result whole, null keys have no pairs."""
    written = []
    keep = correlation.materialise
    monkeypatch.setattr(correlation, "materialise", lambda *a: written.append(keep(*a)) or written[-1])
    series = [[1, 2, 3, 4, 9], [9, 8, 7, 6, 1], [5, 0, 0, 0, 5]]
    vectors = spark.createDataFrame([(i, series[i % 3]) for i in range(1200)] + [(None, series[0])], "beat int, counts array<bigint>")
    pairs = correlation.pairwise_correlation(vectors, "beat", 5, least=0.99)
    assert sum(rows.count() for rows in written) < 1200
    found = {(r.key1, r.key2): r.corr for r in pairs.collect()}
    wanted = {(a, b): 1.0 if a % 3 == b % 3 else -1.0 for a in range(1200) for b in range(a + 1, 1200) if (a % 3 == 2) == (b % 3 == 2)}
    assert len(wanted) == 400 * 399 // 2 * 3 + 400 * 400 and found == pytest.approx(wanted, abs=1e-9)


def test_welch_t(spark):
    data = [(0, 10), (0, 12), (0, 17), (1, 20), (1, 25)]
    samples = spark.createDataFrame(data, "label int, n bigint")
    t = contrasts.welch_t(samples, "n", "label").head().t
    assert math.isclose(t, (22.5 - 13.0) / math.sqrt(13.0 / 3 + 12.5 / 2))
    assert contrasts.welch_t(samples.limit(4), "n", "label").head().t is None
    same = spark.createDataFrame([(0, 5), (0, 5), (1, 5), (1, 5)], "label int, n bigint")
    assert contrasts.welch_t(same, "n", "label").head().t is None


def test_yearly_counts_skip_unknown_years(spark):
    rows = spark.createDataFrame([(2010,), (2010,), (2011,), (None,)], "y int")
    assert rows_of(contrasts.yearly_counts(rows, F.col("y"), 2011), "year", "n", "label") == [
        (2010, 2, 0), (2011, 1, 1),
    ]


def test_chi_square_agrees_with_spark_ml(spark):
    random.seed(5)
    data = [(random.randint(0, 2), random.randint(0, 6)) for _ in range(200)]
    samples = spark.createDataFrame(data, "label int, n bigint")
    own = contrasts.chi_square_test(samples, "n", "label").head()
    vectors = VectorAssembler(inputCols=["n"], outputCol="v").transform(samples)
    ml = ChiSquareTest.test(vectors, "v", "label", True).head()
    assert own.dof == ml.degreesOfFreedom == 12
    assert math.isclose(own.statistic, ml.statistic, rel_tol=1e-9)
    assert math.isclose(own.p_value, ml.pValue, abs_tol=1e-9) and 0 < own.p_value < 1


def test_chi_square_takes_any_number_of_values(spark):
    samples = spark.range(20_000).select(F.col("id").alias("n"), (F.col("id") % 2).alias("label"))
    row = contrasts.chi_square_test(samples, "n", "label").head()
    assert (row.dof, row.statistic) == (19_999, pytest.approx(20_000)) and row.p_value == pytest.approx(0.4967, abs=1e-3)
    one = contrasts.chi_square_test(samples.withColumn("n", F.lit(1)), "n", "label").head()
    assert (one.dof, one.p_value) == (0, 1.0)


def test_lags_go_by_row_and_nulls_are_dropped_afterwards(spark):
    data = [("a", 2016, 1, 10), ("a", 2016, 5, 11), ("a", 2016, 53, 12), ("a", 2017, 1, 13), ("b", 2016, 1, 5)]
    rows = spark.createDataFrame(data, "beat string, year int, week int, crimes bigint")
    lagged = counts.with_lags(rows, ["beat"], ["year", "week"], "crimes", 2, "next_week")
    assert rows_of(lagged, "beat", "year", "week", "lag1", "lag2", "next_week") == [("a", 2016, 53, 11, 10, 13)]


def test_a_beat_in_two_areas_has_a_defined_order(spark):
    data = [("a", 2016, w, float(area), 10 * w + area) for w in range(1, 5) for area in (2, 1)]
    rows = spark.createDataFrame(data, "beat string, year int, week int, area double, crimes bigint")
    results = {
        tuple(rows_of(counts.with_lags(r, ["beat"], ["year", "week", "area"], "crimes", 1, "next_week")))
        for r in (rows, rows.repartition(5), rows.orderBy(F.desc("area")))
    }
    assert len(results) == 1
    assert counts.with_lags(rows, ["beat"], ["year", "week", "area"], "crimes", 1, "next_week").count() == 6


def test_majority_is_more_than_half(spark):
    rows = spark.createDataFrame([(4, 2), (4, 3), (0, 0)], "crimes bigint, arrests bigint")
    assert rows_of(counts.with_majority_flag(rows), "crimes", "arrests", "violent") == [
        (0, 0, "false"), (4, 2, "false"), (4, 3, "true"),
    ]


def _bars(spark, data):
    return spark.createDataFrame(data, "trade_id int, bar_num int, profit double")


def test_group_without_closing_bar_gives_no_summary(spark):
    rows = bars.with_previous_group(_bars(spark, [(1, b, float(b * b)) for b in range(1, 26)]))
    found = {r.bar_num: r for r in rows.collect()}
    assert len(found) == 25
    assert all(found[b].profit_first is None for b in range(1, 11))
    assert (found[11].profit_first, found[20].profit_last, found[15].profit_mean) == (1.0, 100.0, 38.5)
    assert math.isclose(found[12].profit_std, math.sqrt(10510.5 / 9))
    assert (found[21].profit_first, found[25].profit_last) == (121.0, 400.0)
    open_group = bars.with_previous_group(_bars(spark, [(1, b, 1.0) for b in range(1, 25) if b != 20]))
    assert all(r.profit_first is None for r in open_group.filter("bar_num > 20").collect())


def test_summaries_equal_the_running_window_at_the_closing_bar(spark):
    random.seed(3)
    data = [(t, b, random.uniform(-5, 5)) for t in range(4) for b in range(1, 38) if random.random() < 0.9]
    rows = _bars(spark, data)
    window = Window.partitionBy("trade_id", "g").orderBy("bar_num")
    wanted = (
        rows.withColumn("g", bars.bar_group(F.col("bar_num")))
        .select(
            "trade_id", (F.col("g") + 1).alias("bar_group"), "bar_num",
            F.first("profit").over(window).alias("profit_first"), F.last("profit").over(window).alias("profit_last"),
            F.round(F.avg("profit").over(window), 9).alias("profit_mean"),
            F.round(F.stddev("profit").over(window), 9).alias("profit_std"),
        )
        .filter("bar_num % 10 = 0")
        .drop("bar_num")
    )
    found = bars.group_summaries(rows.withColumn("bar_group", bars.bar_group(F.col("bar_num"))))
    found = found.withColumns({c: F.round(c, 9) for c in ("profit_mean", "profit_std")})
    assert rows_of(found, *wanted.columns) == rows_of(wanted, *wanted.columns)


def test_a_repeated_closing_bar_does_not_multiply_rows(spark):
    data = [(1, b, float(b)) for b in range(1, 16)] + [(1, 10, 10.0)]
    assert bars.with_previous_group(_bars(spark, data)).count() == 16


def test_a_repeated_bar_gives_the_same_summary_in_any_row_order(spark):
    data = [(1, b, float(b)) for b in range(1, 12)] + [(1, 1, 9.0), (1, 1, 5.0), (1, 10, 3.0)]
    for rows in (data, data[::-1]):
        row = bars.with_previous_group(_bars(spark, rows)).filter("bar_num = 11").head()
        assert (row.profit_first, row.profit_last) == (1.0, 10.0)


def test_a_null_first_profit_stays_null(spark):
    data = [(1, b, None if b == 1 else float(b)) for b in range(1, 12)]
    row = bars.with_previous_group(_bars(spark, data)).filter("bar_num = 11").head()
    assert row.profit_first is None and row.profit_last == 10.0


def test_running_totals_equal_a_plain_window(spark):
    random.seed(7)
    # Half of the rows share one key, some have no key and some no day.
    data = [
        (
            random.choice(["hot"] * 6 + ["a", "b", "c", "d", None]),
            random.choice([*range(9), None]),
            i,
            random.randint(-9, 9),
        )
        for i in range(600)
    ]
    rows = spark.createDataFrame(data, "k string, day int, i int, v int")
    order = [F.col("day"), F.col("i")]
    window = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    wanted = rows.select("i", F.sum("v").over(window).alias("v"), F.row_number().over(window).cast("bigint").alias("n"))
    found = running.running_totals(
        rows.withColumnRenamed("v", "x"), {"v": F.col("x"), "n": F.lit(1)}, order, ("k",)
    )
    assert rows_of(found, "i", "v", "n") == rows_of(wanted, "i", "v", "n")
    numbers = running.numbered(rows, "n", ("k",), order)
    assert numbers.columns == [*rows.columns, "n"]
    assert rows_of(numbers, "i", "n") == rows_of(wanted, "i", "n")


def test_running_totals_without_keys(spark):
    rows = spark.range(1000).select("id", (F.col("id") * 37 % 101).alias("v"))
    found = running.running_totals(rows, {"t": F.col("v")}, [F.desc("id")])
    total = sum(i * 37 % 101 for i in range(1000))
    wanted = [(i, total - sum(j * 37 % 101 for j in range(i))) for i in range(1000)]
    assert rows_of(found, "id", "t") == wanted


@pytest.mark.parametrize("days", ["one", "crowded", "spread"])
def test_a_hot_key_is_cut_into_even_slices(spark, conf, monkeypatch, days):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    day = {"one": F.lit(1), "crowded": F.when(F.col("id") % 5 > 0, 1).otherwise(F.col("id")), "spread": F.col("id")}[days]
    rows = spark.range(20_000).select(F.lit("hot").alias("k"), day.alias("day"), "id")
    written = []
    keep = running.materialise
    monkeypatch.setattr(running, "materialise", lambda *a: written.append(keep(*a)) or written[-1])
    found = running.numbered(rows, "n", ("k",), [F.col("day"), F.col("id")])
    assert found.agg(F.max("n"), F.countDistinct("n")).head()[:] == (20_000, 20_000)
    sizes = [r["count"] for r in written[0].groupBy("_slice").count().collect()]
    assert max(sizes) <= 2.2 * sum(sizes) / len(sizes) and len(sizes) >= 4


def test_present_folds_have_both_roles(spark):
    data = [(2008, 5), (2008, 7), (2009, 1), (2009, 3), (2010, 7), (None, 1)]
    months = spark.createDataFrame(data, "year int, month int")
    assert folds.present_folds(months) == [(2008, 1), (2008, 2)]
    assert folds.present_folds(months, 2009) == [] and folds.present_folds(months.limit(0)) == []


def test_folds(spark):
    assert folds.half_years(2008, 2015)[:3] == [(2008, 1), (2008, 2), (2009, 1)]
    assert len(folds.half_years(2008, 2015)) == 15 and folds.half_years(2008, 2015)[-1] == (2015, 1)
    months = [(y, m) for y in range(2007, 2011) for m in range(1, 13)] + [(None, 1), (2008, None)]
    rows = spark.createDataFrame(months, "year int, month int")
    chosen = folds.half_years(2008, 2010)
    for fold in chosen:
        train = rows_of(rows.filter(folds.train_filter(fold)), "year", "month")
        test = rows_of(rows.filter(folds.test_filter(fold)), "year", "month")
        assert len(train) == 6 and len(test) == 1 and not set(train) & set(test) and max(train) < test[0]
        for role, wanted in (("train", train), ("test", test)):
            found = folds.in_folds(rows, role, [fold])
            assert rows_of(found, "year", "month") == wanted
    sizes = rows_of(folds.fold_sizes(rows, chosen), "fold_year", "half", "role", "n")
    assert sizes == sorted((y, h, r, n) for y, h in chosen for r, n in (("test", 1), ("train", 6)))


def test_zero_profit_is_skipped_by_the_mean(spark):
    data = [(2008, 1, 10.0), (2008, 2, 30.0), (2008, 7, 0.0), (2008, 7, 40.0)]
    rows = spark.createDataFrame(data, "year int, month int, profit double")
    assert rows_of(folds.baseline_errors(rows, [(2008, 1)], "profit"), "fold_year", "half", "mape") == [(2008, 1, 50.0)]
    assert rows.select(percentage_error(F.lit(1.0), F.lit(0.0)).alias("e")).head().e is None


def test_fold_summary(spark):
    errors = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 60.0)], "f int, mape double")
    assert tuple(folds.fold_summary(errors).head()) == (30.0, 10.0, 60.0)


def test_mape_counts_rows_with_zero_actual(spark):
    rows = spark.createDataFrame([(10.0, 20, "a"), (5.0, 0, "a"), (30.0, 20, "b")], "p double, y bigint, s string")
    assert rows_of(accuracy.mape(rows, "p", "y", ["s"]), "s", "n", "mape") == [("a", 2, 25.0), ("b", 1, 50.0)]
    by_slice = dict(rows_of(accuracy.mape_by_slice(rows, "p", "y", "s"), "slice", "mape"))
    assert by_slice["a"] == 25.0 and by_slice["b"] == 50.0 and math.isclose(by_slice["all"], 100 / 3)


def test_accuracy_and_propensity(spark):
    data = [(1.0, 1, "x"), (0.0, 1, "x"), (0.0, 0, "y"), (0.0, 0, "y")]
    rows = spark.createDataFrame(data, "p double, y int, s string")
    assert tuple(accuracy.accuracy(rows, "p", "y", []).head()) == (4, 0.75)
    found = [tuple(r) for r in accuracy.propensity(rows, "s", "p", "y").collect()]
    assert found == [("x", 2, 0.5, 1.0), ("y", 2, 0.0, 0.0)]


def test_threshold_measures_agree_with_spark_ml(spark):
    random.seed(11)
    data = [(round(random.random(), 2), random.randint(0, 1)) for _ in range(3000)] + [(0.5, 1)] * 1500 + [(None, 1)]
    scored = spark.createDataFrame(data, "score double, label int")
    table = accuracy.threshold_counts(scored, "score", "label")
    ranked = scored.filter("score is not null").withColumn("rawPrediction", F.col("score"))
    area = BinaryClassificationEvaluator(labelCol="label", numBins=0).evaluate(ranked)
    assert math.isclose(accuracy.area_under_roc(table).head().auc, area, rel_tol=1e-9)
    kept = [(s, y) for s, y in data if s is not None]
    for row in accuracy.threshold_sweep(table).collect():
        tp = sum(1 for s, y in kept if s >= row.threshold and y == 1)
        fp = sum(1 for s, y in kept if s >= row.threshold and y == 0)
        assert (row.tp, row.fp) == (tp, fp)
        assert math.isclose(row.f_measure, 2 * row.precision * row.recall / (row.precision + row.recall))
    best = accuracy.best_threshold(accuracy.threshold_sweep(table)).head()
    assert best.f_measure == max(r.f_measure for r in accuracy.threshold_sweep(table).collect())
    curve = [tuple(r) for r in accuracy.roc_curve(table).collect()]
    assert curve[0] == (0.0, 0.0) and curve[-1] == (1.0, 1.0) and curve == sorted(curve)


def test_a_single_score_can_be_swept(spark):
    scored = spark.createDataFrame([(0.3, 1), (0.3, 0), (0.3, 1)], "score double, label int")
    table = accuracy.threshold_counts(scored, "score", "label")
    assert rows_of(table, "threshold", "tp", "fp", "positives", "negatives") == [(0.3, 2, 1, 2, 1)]
    assert accuracy.area_under_roc(table).head().auc == 0.5


def test_label_is_the_presence_of_basic(spark):
    inspections = spark.createDataFrame(
        [("t1", None, "2"), ("t1", "b", "x"), ("t3", "b", "1")],
        "truck_number_one string, basic string, time_weight string",
    )
    fleet = spark.createDataFrame(
        [("t1", "10.5", "2001", "IL", None)],
        "truck_number string, purchase_price string, model_year string, state string, manufacturer string",
    )
    found = classes.label_features(inspections, fleet, "truck_number_one", "truck_number")
    assert rows_of(found, *classes.NUMERIC, *classes.CATEGORICAL, "label") == [
        (2.0, 10.5, 2001.0, "IL", None, 0), (None, 10.5, 2001.0, "IL", None, 1),
    ]


def test_parts_do_not_depend_on_partitioning(spark):
    rows = spark.range(20000)
    results = [
        rows_of(classes.with_part(r, ["id"]).filter("part = 'test'"), "id")
        for r in (rows, rows.repartition(3), rows.orderBy(F.desc("id")))
    ]
    assert results[0] == results[1] == results[2]
    assert 3700 < len(results[0]) < 4300
