from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import rows_of
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from almanac.models import categories, cells, classify, forecast, newton, pipelines, trees, walkforward
from almanac.operators import folds
from almanac.operators.classes import CATEGORICAL, NUMERIC


@pytest.fixture(scope="module")
def inspections(spark):
    """The label follows time_weight; state ZZ is seen in the test part only, and one manufacturer is null."""
    i = F.col("id")
    return spark.range(600).select(
        (i % 60).cast("double").alias("time_weight"),
        (100.0 + i % 7).alias("purchase_price"),
        (2000.0 + i % 11).alias("model_year"),
        F.when(i % 97 == 5, "ZZ").when(i % 3 == 0, "IL").otherwise("TX").alias("state"),
        F.when(i % 13 != 0, F.concat(F.lit("m"), i % 4)).alias("manufacturer"),
        (i % 60 > 30).cast("int").alias("label"),
        F.when((i % 5 == 0) | (i % 97 == 5), "test").otherwise("train").alias("part"),
    ).cache()


@pytest.mark.parametrize("kind", ["gbt", "forest", "logistic"])
def test_classifiers_cope_with_unseen_and_null_categories(inspections, kind):
    model = classify.fit(inspections, kind, **({"maxIter": 5} if kind == "gbt" else {}))
    found = {r.part: r for r in classify.part_accuracy(model, inspections).collect()}
    assert found["train"].n + found["test"].n == 600
    assert found["train"].accuracy > 0.9 and found["test"].accuracy > 0.9


def test_the_best_training_threshold_is_used_on_both_parts(inspections):
    model = classify.fit(inspections, "logistic")
    scored = [(r.part, r.score, r.label) for r in classify.with_score(model, inspections).collect()]
    train = [(s, y) for part, s, y in scored if part == "train"]

    def f_measure(t):
        hits = sum(y for s, y in train if s >= t)
        return 2 * hits / (sum(s >= t for s, _ in train) + sum(y for _, y in train))

    best = max((f_measure(t), t) for t in {s for s, _ in train})[1]
    found = {r.part: r for r in classify.threshold_accuracy(model, inspections).collect()}
    for part, row in found.items():
        right = [(s >= best) == y for p, s, y in scored if p == part]
        assert row.threshold == best and (row.n, row.accuracy) == (len(right), sum(right) / len(right))


def test_logistic_coefficients_agree_with_newton_steps(spark):
    rng = np.random.default_rng(4)
    numbers = rng.normal(size=(400, 3))
    label = (rng.random(400) < 1 / (1 + np.exp(-(numbers @ [1.0, -2.0, 0.5] + 0.3)))).astype(int)
    weights = np.zeros(4)
    design = np.hstack([numbers, np.ones((400, 1))])
    for _ in range(25):
        p = 1 / (1 + np.exp(-design @ weights))
        weights += np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]), design.T @ (label - p))
    rows = spark.createDataFrame(
        [(*map(float, x), "s", "m", int(y), "train") for x, y in zip(numbers, label)],
        "time_weight double, purchase_price double, model_year double, state string, manufacturer string, "
        "label int, part string",
    )
    model = classify.fit(rows, "logistic", tol=1e-10)
    found = {r.term: r.coefficient for r in pipelines.coefficients(model, rows).collect()}
    assert [found[name] for name in NUMERIC] == pytest.approx(list(weights[:3]), abs=1e-3)


def test_forest_errors_equal_those_of_the_collected_predictions(spark):
    i = F.col("id")
    rows = spark.range(500).select(
        (i % 7).cast("string").alias("beat"), *[(i * k % 11).alias(f"lag{k}") for k in range(1, 5)],
        (i % 3).cast("double").alias("area"), (i * 5 % 13).alias("next_week"),
        F.when(i % 4 == 0, "true").otherwise("false").alias("violent"),
        F.when(i % 5 == 0, "test").otherwise("train").alias("part"),
    )
    model = forecast.fit_forest(rows, numTrees=5)
    predicted = [r for r in model.transform(rows).collect() if r.part == "test"]
    for row in forecast.forest_errors(model, rows).collect():
        chosen = [r for r in predicted if row.slice in ("all", r.violent)]
        # A week of no crimes adds no error but counts.
        errors = [abs(r.prediction - r.next_week) / r.next_week for r in chosen if r.next_week]
        assert row.n == len(chosen) > len(errors) and row.mape == pytest.approx(100 * sum(errors) / len(chosen))


def test_rows_without_a_number_are_incomplete(spark):
    rows = spark.createDataFrame(
        [(1.0, 2.0, 3.0, None, "m", 1), (None, 2.0, 3.0, "s", "m", 0)],
        "time_weight double, purchase_price double, model_year double, state string, manufacturer string, label int",
    )
    assert rows_of(classify.complete_rows(rows), "label") == [(1,)]


def test_importances_are_named_ranked_and_sum_to_one(inspections):
    model = classify.fit(inspections, "forest")
    every = pipelines.feature_importances(model, 1000).collect()
    names = [r.feature for r in every]
    assert len(names) == len(set(names)) and set(NUMERIC) <= set(names)
    assert any(n.startswith(f"{CATEGORICAL[0]}_vector_") for n in names)
    assert math.isclose(sum(r.score for r in every), 1.0)
    top = pipelines.feature_importances(model, 8).collect()
    assert len(top) == 8 and top == every[:8] and top[0].feature == "time_weight"


def test_boosted_trees_of_merged_rows_are_those_of_the_rows(spark, monkeypatch):
    """More rows than the estimator draws, numbers of many values, categories that the draw misses, and null ones."""
    i, noise = F.col("id"), F.pmod(F.xxhash64("id"), F.lit(100))
    rows = spark.range(30_000).select(
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)).cast("double").alias("time_weight"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(20_000)) / 7 - 900).alias("purchase_price"),
        F.pmod(F.xxhash64("id", F.lit(3)), F.lit(5)).cast("double").alias("model_year"),
        F.when(i % 1500 == 7, F.concat(F.lit("rare"), i)).otherwise(F.concat(F.lit("s"), i % 3)).alias("state"),
        F.when(i % 13 != 0, F.concat(F.lit("m"), i % 2)).alias("manufacturer"), i, noise.alias("noise"),
    )
    told = F.col("time_weight") * 2 + F.col("purchase_price") / 50 + F.when(F.col("state") == "s1", 30).otherwise(0)
    rows = rows.select(
        *NUMERIC, *CATEGORICAL, (told + F.col("model_year") * F.col("model_year") + F.col("noise") > 100).cast("int").alias("label"),
        F.when(i % 6 == 0, "test").otherwise("train").alias("part"), "id",
    ).cache()
    plain = rows.drop("id")
    whole = classify.fit(plain, "gbt", maxIter=4)
    monkeypatch.setattr(cells, "MERGE_FROM", 1)
    model, merged = classify.fitted(plain, "gbt", maxIter=4)
    assert whole.cells is None and model.cells is not None
    # Two parts and labels; bins of the numbers; slots of the categories in the draw, and one for what is not in it.
    n_slots = model.cells.slots.count()
    assert [len(b) for b in model.cells.bounds.values()][2] == 4 and max(map(len, model.cells.bounds.values())) < 32
    assert 5 < n_slots < 3 + 20 + 3 and merged.count() < 0.8 * rows.count()
    assert merged.agg(F.sum("weight")).head()[0] == 30_000
    wanted = dict(rows_of(pipelines.feature_importances(whole, 100), "feature", "score"))
    found = dict(rows_of(pipelines.feature_importances(model, 100), "feature", "score"))
    assert found == pytest.approx(wanted, abs=1e-9) and sum(score > 0 for score in wanted.values()) >= 4
    assert sorted(classify.part_accuracy(model, merged).collect()) == sorted(classify.part_accuracy(whole, plain).collect())
    told_by = [sorted(rows_of(m.transform(rows), "id", "prediction")) for m in (whole, model)]
    assert told_by[0] == told_by[1] and len(told_by[0]) == 30_000


def test_merged_rows_are_bounded_by_bins(spark, monkeypatch):
    """Every price is another, so equal rows alone would merge nothing."""
    monkeypatch.setattr(cells, "MERGE_FROM", 1)
    i = F.col("id")
    rows = spark.range(40_000).select(
        (i % 2).cast("double").alias("time_weight"), i.cast("double").alias("purchase_price"),
        F.lit(1.0).alias("model_year"), F.lit("s").alias("state"), F.lit("m").alias("manufacturer"),
        (i % 3 == 0).cast("int").alias("label"), F.lit("train").alias("part"),
    )
    _, merged = classify.fitted(rows, "gbt", maxIter=1)
    assert merged.count() <= 2 * 32 * 2


def test_packed_columns_come_back_as_they_were(spark):
    """Nulls, least and most values, one value only, and more bits than a long has."""
    most = {"a": 1, "b": 2**31 - 1, "c": 33, "d": 2**30, "e": 0}
    schema = "part string, a double, b int, c double, d int, e double"
    rows = spark.createDataFrame(
        [("x", 0.0, 0, 0.0, 0, 0.0), ("y", 1.0, 2**31 - 1, 33.0, 2**30, 0.0), (None, None, None, None, None, None), ("x", 1.0, None, 2.0, 5, 0.0)],
        schema,
    )
    packed = cells._pack(rows, ["part"], most)
    assert packed.columns == ["part", "_packed_0", "_packed_1"] and dict(packed.dtypes)["_packed_0"] == "bigint"
    found = cells._unpack(packed, ["part"], most, rows.schema)
    assert found.dtypes == rows.dtypes and set(map(tuple, found.collect())) == set(map(tuple, rows.collect()))


def test_cells_are_counted_by_one_packed_number(spark, monkeypatch):
    """A task holds a group of every cell that it meets, so the key is narrow: beside part and label no column for each feature."""
    monkeypatch.setattr(cells, "MERGE_FROM", 1)
    counted = []
    pack = cells._pack
    monkeypatch.setattr(cells, "_pack", lambda *given: counted.append(pack(*given)) or counted[-1])
    i = F.col("id")
    rows = spark.range(2000).select(
        *[(i % (7 + n)).cast("double").alias(c) for n, c in enumerate(NUMERIC)],
        *[(i % (3 + n)).cast("string").alias(c) for n, c in enumerate(CATEGORICAL)],
        (i % 3 == 0).cast("int").alias("label"), F.lit("train").alias("part"),
    )
    _, merged = classify.fitted(rows, "gbt", maxIter=1)
    assert counted[0].columns == ["part", "label", "_packed_0"]
    assert merged.count() == rows.distinct().count() and merged.agg(F.sum("weight")).head()[0] == 2000


def test_a_bound_belongs_to_the_bin_below_it(spark):
    rows = spark.createDataFrame([(x,) for x in (-2.0, -1.0, -0.5, -0.0, 0.0, 0.1, 3.0, 9.0)], "x double")
    found = cells._with_bins(rows, {"a": ("x", [-1.0, 0.0, 3.0]), "b": ("x", [])}).orderBy("x", "a")
    assert [(r.a, r.b) for r in found.collect()] == [(n, 1.0) for n in (1, 1, 2, 2, 2, 3, 3, 4)]
    assert found.columns == ["x", "a", "b"]


def test_rows_are_merged_only_where_the_trees_stay_the_same():
    assert cells.merges(classify.estimator("gbt"), cells.MERGE_FROM)
    assert not cells.merges(classify.estimator("gbt"), cells.MERGE_FROM - 1)
    assert not cells.merges(classify.estimator("gbt", subsamplingRate=0.5), cells.MERGE_FROM)
    assert not cells.merges(classify.estimator("gbt", minInstancesPerNode=2), cells.MERGE_FROM)


def test_coefficients_recover_a_linear_law(spark):
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("beat"), (F.col("id") % 17).alias("lag1"), (F.col("id") % 5).alias("lag2"),
        F.lit("train").alias("part"),
    ).withColumn("next_week", 3 * F.col("lag1") - 2 * F.col("lag2") + 50)
    terms = dict(rows_of(pipelines.coefficients(forecast.fit_linear(rows), rows), "term", "coefficient"))
    assert terms == {
        "lag1": pytest.approx(3.0), "lag2": pytest.approx(-2.0), "intercept": pytest.approx(50.0),
    }


def test_string_index_orders_by_frequency_then_name(spark):
    rows = spark.createDataFrame([(v,) for v in ["b", "b", "a", "a", "c", "d", "d", "d", None]], "v string")
    found = rows_of(pipelines.string_index(rows, "v").filter("value is not null"), "index", "value", "n")
    assert found == [(0, "d", 3), (1, "a", 2), (2, "b", 2), (3, "c", 1)]


def test_walk_forward_forest(spark):
    i = F.col("id")
    bars = spark.range(2400).select(
        (i % 9).cast("int").alias("x"),
        F.when(i % 50 == 0, None).otherwise((i % 4).cast("double")).alias("profit_first"),
        F.when(i % 48 == 0, 0.0).otherwise(10.0 + i % 9).alias("profit"),
        (2008 + F.floor(i / 1200)).cast("int").alias("year"),
        (i % 12 + 1).cast("int").alias("month"),
    )
    features = ["x", "profit_first"]
    months = walkforward.stage_months(bars, features, "profit")
    assert months.count() == bars.na.drop("any").count()
    chosen = folds.half_years(2008, 2009)
    errors = walkforward.forest_errors(months, features, "profit", chosen, parallelism=3, numTrees=5)
    found = rows_of(errors, "fold_year", "half", "mape")
    assert [(y, h) for y, h, _ in found] == chosen
    assert all(m is not None and 0 <= m < 20 for _, _, m in found)
    assert rows_of(
        walkforward.forest_errors(months, features, "profit", chosen, parallelism=1, numTrees=5),
        "fold_year", "half", "mape",
    ) == found


def test_categories_are_indexed_as_by_the_library(spark):
    """Spark's own indexer and encoder, on a column of few values, give the same slots."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    rows = spark.createDataFrame(
        [(float(i), v, w) for i, (v, w) in enumerate([("b", "x"), ("a", "y"), ("b", None), ("c", "y"), (None, "z"), ("a", "q")])],
        "n double, v string, w string",
    )
    train = rows.filter("n < 5")
    index = categories.category_index(train, ["v", "w"])
    found = categories.encode(rows, index, ["n"], ["v", "w"])
    stages = [
        StringIndexer(inputCols=["v", "w"], outputCols=["vi", "wi"], handleInvalid="keep"),
        OneHotEncoder(inputCols=["vi", "wi"], outputCols=["vv", "wv"], handleInvalid="keep"),
        VectorAssembler(inputCols=["n", "vv", "wv"], outputCol="features"),
    ]
    wanted = Pipeline(stages=stages).fit(train).transform(rows)
    assert {r.n: r.features.toArray().tolist() for r in found.collect()} == {
        r.n: r.features.toArray().tolist() for r in wanted.collect()
    }
    names = rows_of(categories.feature_names(index, ["n"], ["v", "w"]), "slot", "feature")
    assert names == list(enumerate([
        "n", "v_vector_b", "v_vector_a", "v_vector_c", "v_vector___unknown", "w_vector_y", "w_vector_x", "w_vector_z",
        "w_vector___unknown",
    ]))


def test_a_fit_on_two_hundred_thousand_categories(spark):
    """Every category has its own weight, and its names never come to the driver as labels."""
    i = F.col("id")
    rows = spark.range(400_000).select(
        F.concat(F.lit("c"), i % 200_000).alias("code"), (i % 2).cast("double").alias("label"), (i % 5 == 0).cast("double").alias("x"),
    )
    index = categories.category_index(rows, ["code"])
    encoded = categories.encode(rows, index, ["x"], ["code"])
    logistic = LogisticRegression(labelCol="label", maxIter=6, regParam=1e-6)
    model = categories.fit_encoded(logistic, encoded, index, ["x"], ["code"])
    assert model.fitted.numFeatures == 200_002
    judged = model.transform(encoded)
    assert judged.filter("prediction = label").count() == 400_000
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    unseen = model.transform(spark.createDataFrame([("new", 0.0), (None, 1.0)], "code string, x double"))
    assert unseen.count() == 2


def test_an_index_of_no_rows(spark):
    rows = spark.createDataFrame([], "v string, n double")
    index = categories.category_index(rows, ["v"])
    assert not index.collect() and not categories.encode(rows, index, ["n"], ["v"]).collect()


@pytest.fixture(scope="module")
def grown(spark):
    """Rows whose label follows three numbers, and a forest of two trees without sampling."""
    i = F.col("id")
    rows = spark.range(4000).select(
        (i % 13).cast("double").alias("a"), (i * 7 % 11).cast("double").alias("b"), (i % 5).cast("double").alias("c"),
        ((i % 13 > 6) & (i * 7 % 11 < 8) | (i % 97 == 0)).cast("double").alias("label"),
    )
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=2, maxDepth=4, bootstrap=False, featureSubsetStrategy="all", seed=3)
    return vectors, forest.fit(vectors)


def test_rows_end_in_the_leaf_that_predicts_them(spark, grown):
    rows, model = grown
    nodes = trees.node_table(spark, model)
    leaves = nodes.filter("feature IS NULL").select("tree", "node", F.col("prediction").alias("leaf"))
    ended = trees.routed(model.transform(rows), nodes).withColumn("node", F.element_at("path", -1))
    assert ended.count() == 8000
    votes = ended.join(leaves, ["tree", "node"])
    assert votes.count() == 8000 and votes.filter("leaf <> prediction").count() == 0  # both trees are alike


@pytest.mark.parametrize("form", ["vector", "array", "stored"])
def test_importances_from_rows_equal_the_models_own(spark, grown, form):
    rows, model = grown
    features = {
        "vector": F.col("features"), "array": F.array("a", "b", "c"),
        "stored": F.struct(F.array(*map(F.lit, (0, 1, 2))).alias("indices"), F.array("a", "b", "c").alias("values")),
    }[form]
    given = rows.select(features.alias("features"), "label")
    gains = trees.split_gains(given, trees.node_table(spark, model), "label", "gini")
    found = {r.feature: r.score for r in trees.importances(gains).collect()}
    wanted = {i: s for i, s in enumerate(model.featureImportances.toArray()) if s}
    assert found == pytest.approx(wanted)


def test_a_tree_without_splits_has_no_gains(spark):
    same = spark.createDataFrame([(1.0, 1.0)] * 3, "a double, label double")
    rows = VectorAssembler(inputCols=["a"], outputCol="features").transform(same)
    model = RandomForestRegressor(numTrees=1, labelCol="label").fit(rows)
    gains = trees.split_gains(rows, trees.node_table(spark, model), "label", "variance")
    assert not gains.collect() and not trees.importances(gains).collect()


def test_newton_steps_agree_with_the_library_and_give_errors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 2)) * [3.0, 100.0] + [10.0, -40.0]
    y = (rng.random(600) < 1 / (1 + np.exp(-(0.5 * (x[:, 0] - 10) - 0.01 * x[:, 1])))).astype(int)
    rows = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, label int")
    found = {r.term: (r.coefficient, r.std_error) for r in newton.logistic_newton(rows, ["a", "b"], "label").collect()}
    design = np.hstack([x, np.ones((600, 1))])
    weights = np.array([found[t][0] for t in ("a", "b", "intercept")])
    p = 1 / (1 + np.exp(-design @ weights))
    assert np.abs(design.T @ (y - p)).max() < 1e-6
    errors = np.sqrt(np.diag(np.linalg.inv(design.T @ (design * (p * (1 - p))[:, None]))))
    assert [found[t][1] for t in ("a", "b", "intercept")] == pytest.approx(list(errors))
    counted = rows.groupBy("a", "b", "label").agg((F.count("*") * 2).alias("n"))
    twice = {r.term: r.std_error for r in newton.logistic_newton(counted, ["a", "b"], "label", "n").collect()}
    assert twice["a"] == pytest.approx(errors[0] / math.sqrt(2))


def test_newton_steps_of_odd_rows(spark):
    empty = spark.createDataFrame([], "a double, label int")
    assert not newton.logistic_newton(empty, ["a"], "label").collect()
    constant = spark.createDataFrame([(2.0, 0), (2.0, 1), (2.0, 1), (None, 0)], "a double, label int")
    found = {r.term: r.coefficient for r in newton.logistic_newton(constant, ["a"], "label").collect()}
    assert found["a"] * 2 + found["intercept"] == pytest.approx(math.log(2))
