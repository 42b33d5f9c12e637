"""Returned line items as inspections, parts as trucks."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.models import classify, trees
from almanac.models.categories import EncodedModel, category_index, encode, fit_encoded
from almanac.models.newton import logistic_newton as newton_steps
from almanac.models.pipelines import coefficients, feature_importances, pipeline, string_index as index_categories
from almanac.operators import accuracy
from almanac.operators.classes import NUMERIC, label_features as join_features, with_part, with_part_by
from almanac.operators.hot_joins import heavy_keys
from almanac.operators.running import placed
from almanac.plans.newton_sql import newton
from almanac.plans.registry import query
from almanac.plans.tree_sql import grown, pruned, splits
from almanac.sources import fit_layout, materialise, table


def _features(spark: SparkSession, folder: str, *carry: str, spread: bool = False) -> DataFrame:
    inspections = table(spark, folder, "lineitem").select(
        *carry, "l_partkey", F.col("l_quantity").alias("time_weight"),
        F.nullif("l_returnflag", F.lit("N")).alias("basic"),
    )
    fleet = table(spark, folder, "part").select(
        "p_partkey", F.col("p_retailprice").alias("purchase_price"), F.col("p_size").alias("model_year"),
        F.col("p_type").alias("state"), F.col("p_brand").alias("manufacturer"),
    )
    return join_features(inspections, fleet, "l_partkey", "p_partkey", carry, spread)


def _fitted(spark: SparkSession, folder: str, kind: str) -> tuple[EncodedModel, DataFrame]:
    """A model of complete rows, and the rows, which were encoded, and merged if many, and written once for its many passes."""
    keys = ("l_orderkey", "l_linenumber")
    rows = with_part(classify.complete_rows(_features(spark, folder, *keys)), list(keys)).drop(*keys)
    return classify.fitted(materialise(rows, "classes"), kind)


LABEL_SQL = """
    SELECT l_quantity AS time_weight, p_retailprice AS purchase_price, CAST(p_size AS DOUBLE) AS model_year,
           p_type AS state, p_brand AS manufacturer,
           CASE WHEN nullif(l_returnflag, 'N') IS NULL THEN 0 ELSE 1 END AS label
    FROM lineitem JOIN part ON l_partkey = p_partkey
"""


@query("label_features", LABEL_SQL)
def label_features(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder)


@query("label_features_spread", LABEL_SQL)
def label_features_spread(spark: SparkSession, folder: str) -> DataFrame:
    """The same join with the parts of many line items found by a sketch and split."""
    return _features(spark, folder, spread=True)


@query(
    "heavy_quantities",
    "SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY l_quantity HAVING count(*) >= 0.02 * (SELECT count(*) FROM lineitem)",
)
def heavy_quantities(spark: SparkSession, folder: str) -> DataFrame:
    """Quantities of at least a fiftieth of all line items."""
    return heavy_keys(table(spark, folder, "lineitem", "l_quantity"), ["l_quantity"], 0.02)


@query(
    "string_index",
    """
    SELECT p_type AS value, count(*) AS n,
           CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS INTEGER) AS index
    FROM part GROUP BY p_type
    """,
)
def string_index(spark: SparkSession, folder: str) -> DataFrame:
    return index_categories(table(spark, folder, "part", "p_type"), "p_type")


@query("classify_gbt")
def classify_gbt(spark: SparkSession, folder: str) -> DataFrame:
    return classify.part_accuracy(*_fitted(spark, folder, "gbt"))


@query("feature_importance_topk")
def feature_importance_topk(spark: SparkSession, folder: str) -> DataFrame:
    model, _ = _fitted(spark, folder, "gbt")
    return feature_importances(model, 8)


@query("classify_forest")
def classify_forest(spark: SparkSession, folder: str) -> DataFrame:
    return classify.part_accuracy(*_fitted(spark, folder, "forest"))


@query("classify_logistic")
def classify_logistic(spark: SparkSession, folder: str) -> DataFrame:
    """The threshold is found on the training part and used on both."""
    return classify.threshold_accuracy(*_fitted(spark, folder, "logistic"))


@query("logistic_coefficients")
def logistic_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    return coefficients(*_fitted(spark, folder, "logistic"))


@query("logistic_best_threshold")
def logistic_best_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """The threshold that serves the fitted model best on its own training rows."""
    model, rows = _fitted(spark, folder, "logistic")
    scored = classify.with_score(model, rows.filter(F.col("part") == "train"))
    return accuracy.best_threshold(accuracy.threshold_sweep(accuracy.threshold_counts(scored, "score", "label")))


@query(
    "logistic_state_rates",
    """
    SELECT p_type AS state, count(*) AS n,
           round(avg(CASE WHEN l_returnflag <> 'N' THEN 1e0 ELSE 0e0 END), 4) AS score
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE (l_orderkey + l_linenumber) % 5 <> 0 GROUP BY p_type
    """,
)
def logistic_state_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Without a penalty and with the state as its only variable, the model must give each state its share of labels."""
    rows = with_part_by(
        _features(spark, folder, "l_orderkey", "l_linenumber"), (F.col("l_orderkey") + F.col("l_linenumber")) % 5 == 0
    )
    train = materialise(rows.filter(F.col("part") == "train").select("state", "label"), "states")
    logistic = LogisticRegression(labelCol="label", regParam=0.0, tol=1e-12, maxIter=500)
    index = category_index(train, ["state"])
    encoded = encode(train, index, [], ["state"])
    scored = classify.with_score(fit_encoded(logistic, encoded, index, [], ["state"], sampled=False), encoded)
    return scored.groupBy("state").agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("score"))


# The label follows the quantity but for returned items; the other numbers tell little.
NEWTON_SQL = newton(
    """
    SELECT l_quantity / 50 AS time_weight, p_retailprice / 1000 AS purchase_price, p_size / 50 AS model_year,
           CASE WHEN l_returnflag = 'R' OR l_quantity > 40 THEN 1e0 ELSE 0e0 END AS y
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
    list(NUMERIC),
)


def _numbers(spark: SparkSession, folder: str) -> DataFrame:
    """The numbers of the inspections, in units of a like size, and a label that they tell something about."""
    label = ((F.col("l_returnflag") == "R") | (F.col("l_quantity") > 40)).cast("int")
    items = table(spark, folder, "lineitem", "l_partkey", "l_quantity", "l_returnflag")
    inspections = items.select("l_partkey", (F.col("l_quantity") / 50).alias("time_weight"), label.alias("label"))
    fleet = table(spark, folder, "part").select(
        "p_partkey", (F.col("p_retailprice") / 1000).alias("purchase_price"), (F.col("p_size") / 50).alias("model_year")
    )
    joined = inspections.join(fleet, F.col("l_partkey") == F.col("p_partkey"))
    return materialise(joined.select(*NUMERIC, "label"), "numbers")


@query("logistic_newton", NEWTON_SQL + "SELECT term, round(coefficient, 4) AS coefficient, round(std_error, 4) AS std_error FROM fit")
def logistic_newton(spark: SparkSession, folder: str) -> DataFrame:
    """Coefficients and their errors by Newton steps over grouped sums."""
    fitted = newton_steps(_numbers(spark, folder), list(NUMERIC), "label")
    return fitted.select("term", *[F.round(c, 4).alias(c) for c in ("coefficient", "std_error")])


@query("logistic_coefficients_numeric", NEWTON_SQL + "SELECT term, round(coefficient, 4) AS coefficient FROM fit")
def logistic_coefficients_numeric(spark: SparkSession, folder: str) -> DataFrame:
    """The coefficients of the library's estimator, without a penalty, where they are determined."""
    rows = _numbers(spark, folder)
    logistic = classify.estimator("logistic", tol=1e-12, maxIter=500)
    fitted = coefficients(pipeline(logistic, list(NUMERIC)).fit(rows), rows)
    return fitted.withColumn("coefficient", F.round("coefficient", 4))


@query(
    "logistic_auc",
    NEWTON_SQL + """,
    by_term AS (
        SELECT max(coefficient) FILTER (term = 'time_weight') AS t, max(coefficient) FILTER (term = 'purchase_price') AS p,
               max(coefficient) FILTER (term = 'model_year') AS m FROM fit),
    scores AS (
        SELECT round(t * time_weight + p * purchase_price + m * model_year, 9) AS score, sum(y) AS pos, sum(1 - y) AS neg
        FROM raw, by_term GROUP BY 1),
    counts AS (SELECT pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp FROM scores)
    SELECT round(sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM counts
    """,
)
def logistic_auc(spark: SparkSession, folder: str) -> DataFrame:
    """Area under the curve of a fitted model on its own rows."""
    rows = _numbers(spark, folder)
    logistic = classify.estimator("logistic", tol=1e-12, maxIter=500)
    scored = classify.with_score(pipeline(logistic, list(NUMERIC)).fit(rows), rows)
    auc = accuracy.area_under_roc(accuracy.threshold_counts(scored, "score", "label"))
    return auc.select(F.round("auc", 6).alias("auc"))


@query(
    "forest_stump",
    """
    WITH v AS (SELECT l_quantity AS q, count(*) AS n, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1),
    c AS (SELECT q, sum(n) OVER w AS n1, sum(s) OVER w AS s1, sum(n) OVER () AS nt, sum(s) OVER () AS st
          FROM v WINDOW w AS (ORDER BY q)),
    b AS (SELECT q FROM c WHERE n1 < nt ORDER BY s1 * s1 / n1 + (st - s1) * (st - s1) / (nt - n1) DESC LIMIT 1)
    SELECT min(l_quantity) AS low, max(l_quantity) AS high, count(*) AS n, round(avg(l_extendedprice), 4) AS prediction
    FROM lineitem, b GROUP BY l_quantity <= b.q
    """,
)
def forest_stump(spark: SparkSession, folder: str) -> DataFrame:
    """One tree of depth one on all rows: the split that leaves the least variance, and the means of its two sides."""
    rows = fit_layout(materialise(table(spark, folder, "lineitem", "l_quantity", "l_extendedprice"), "stump"))
    forest = RandomForestRegressor(
        labelCol="l_extendedprice", numTrees=1, maxDepth=1, maxBins=64, bootstrap=False, featureSubsetStrategy="all", seed=1
    )
    judged = pipeline(forest, ["l_quantity"]).fit(rows).transform(rows)
    return judged.groupBy("prediction").agg(
        F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"), F.count("*").alias("n")
    ).select("low", "high", "n", F.round("prediction", 4).alias("prediction"))


# The label follows the quantity but for returned items, so that a tree has something to find.
STUMP_SQL = """
    WITH r AS (SELECT l_quantity AS q, CASE WHEN l_returnflag = 'R' OR l_quantity > 40 THEN 1 ELSE 0 END AS y FROM lineitem),
    v AS (SELECT q, count(*) AS n, sum(y) AS s FROM r GROUP BY 1),
    c AS (SELECT q, sum(n) OVER w AS n1, sum(s) OVER w AS s1, sum(n) OVER () AS nt, sum(s) OVER () AS st
          FROM v WINDOW w AS (ORDER BY q)),
    b AS (SELECT q FROM c WHERE n1 < nt ORDER BY s1 * s1 / n1 + (st - s1) * (st - s1) / (nt - n1) DESC LIMIT 1)
    SELECT min(r.q) AS low, max(r.q) AS high, count(*) AS n, round({score}, 6) AS score
    FROM r, b GROUP BY r.q <= b.q
"""


def _stump(spark: SparkSession, folder: str, kind: str, **params) -> DataFrame:
    """A classifier of one tree of depth one: low and high quantity of its sides, their rows and their score."""
    label = ((F.col("l_returnflag") == "R") | (F.col("l_quantity") > 40)).cast("int")
    items = table(spark, folder, "lineitem", "l_quantity", "l_returnflag").select("l_quantity", label.alias("label"))
    rows = fit_layout(materialise(items, "stump"))
    tree = classify.estimator(kind, maxDepth=1, maxBins=64, featureSubsetStrategy="all", **params)
    scored = classify.with_score(pipeline(tree, ["l_quantity"]).fit(rows), rows)
    return scored.groupBy(F.round("score", 6).alias("score")).agg(
        F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"), F.count("*").alias("n")
    ).select("low", "high", "n", "score")


@query("classify_forest_stump", STUMP_SQL.format(score="avg(r.y)"))
def classify_forest_stump(spark: SparkSession, folder: str) -> DataFrame:
    """Impurity falls most where the squared sums of labels grow most, as for the variance."""
    return _stump(spark, folder, "forest", numTrees=1, bootstrap=False)


@query("classify_gbt_stump", STUMP_SQL.format(score="1 / (1 + exp(-2 * (2 * avg(r.y) - 1)))"))
def classify_gbt_stump(spark: SparkSession, folder: str) -> DataFrame:
    """One boosting round: the score is the logistic function of twice the mean of the labels as -1 and 1."""
    return _stump(spark, folder, "gbt", maxIter=1)


TREE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
# A label that three levels can tell most of: large orders by discount, others by tax, turned round where returned.
TREE_ROWS = f"""
    SELECT 0 AS g, true AS train,
           CASE WHEN (CASE WHEN l_quantity > 30 THEN l_discount > 0.045 ELSE l_tax > 0.045 END) <> (l_returnflag = 'R')
                THEN 1e0 ELSE 0e0 END AS y,
           {", ".join(TREE_FEATURES)}
    FROM lineitem
"""
TREE_DEPTH = 3


def _tree(spark: SparkSession, folder: str, kind: str, depth: int, **params) -> tuple[DataFrame, PipelineModel]:
    """Line items with a label, and one tree of some depth on three of their numbers."""
    told = F.when(F.col("l_quantity") > 30, F.col("l_discount") > 0.045).otherwise(F.col("l_tax") > 0.045)
    label = (told != (F.col("l_returnflag") == "R")).cast("int")
    items = table(spark, folder, "lineitem", *TREE_FEATURES, "l_returnflag").select(*TREE_FEATURES, label.alias("label"))
    rows = materialise(items, "tree")
    tree = classify.estimator(kind, maxDepth=depth, maxBins=64, featureSubsetStrategy="all", **params)
    return rows, pipeline(tree, TREE_FEATURES).fit(fit_layout(rows))


def _tree_scores(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Rows, positives and quantities by the score of their leaf: score, n, positives, quantity."""
    scored = classify.with_score(model, rows)
    return scored.groupBy(F.round("score", 6).alias("score")).agg(
        F.count("*").alias("n"), F.sum("label").alias("positives"), F.sum("l_quantity").alias("quantity")
    )


def _tree_sql(depth: int, score: str) -> str:
    return grown(TREE_ROWS, TREE_FEATURES, depth) + f"""
    SELECT round({score}, 6) AS score, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, sum(l_quantity) AS quantity
    FROM rows_{depth} r JOIN leaves l ON r.node = l.node GROUP BY 1
    """


@query(
    "classify_forest_tree",
    grown(TREE_ROWS, TREE_FEATURES, TREE_DEPTH) + pruned(TREE_DEPTH) + f"""
    SELECT round(mean, 6) AS score, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, sum(l_quantity) AS quantity
    FROM rows_{TREE_DEPTH} r JOIN ends e ON r.node = e.node JOIN means m ON e.upper = m.upper GROUP BY 1
    """,
)
def classify_forest_tree(spark: SparkSession, folder: str) -> DataFrame:
    """A forest of one tree, three levels deep, on all rows."""
    return _tree_scores(*_tree(spark, folder, "forest", TREE_DEPTH, numTrees=1, bootstrap=False))


@query("classify_gbt_tree", _tree_sql(TREE_DEPTH, "1 / (1 + exp(-2 * (2 * mean - 1)))"))
def classify_gbt_tree(spark: SparkSession, folder: str) -> DataFrame:
    """One boosting round, three levels deep."""
    return _tree_scores(*_tree(spark, folder, "gbt", TREE_DEPTH, maxIter=1))


@query(
    "feature_importance_tree",
    grown(TREE_ROWS, TREE_FEATURES, TREE_DEPTH) + pruned(TREE_DEPTH) + f"""
    SELECT CASE feature {" ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(TREE_FEATURES))} END AS feature,
           round(sum(gain) / sum(sum(gain)) OVER (), 6) AS score
    FROM ({splits(TREE_DEPTH)}) s WHERE NOT EXISTS (SELECT 1 FROM same WHERE anc = s.node) GROUP BY 1
    """,
)
def feature_importance_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Importances from the rows: they are routed down the nodes of a fitted tree, and summed at each."""
    rows, model = _tree(spark, folder, "forest", TREE_DEPTH, numTrees=1, bootstrap=False)
    values = rows.select(F.array(*TREE_FEATURES).alias("features"), "label")
    gains = trees.split_gains(values, trees.node_table(spark, model.stages[-1]), "label", "gini")
    names = F.array(*map(F.lit, TREE_FEATURES))
    return trees.importances(gains).select(F.get(names, "feature").alias("feature"), F.round("score", 6).alias("score"))


def _judged(spark: SparkSession, folder: str, *carry: str) -> DataFrame:
    """Line items with a fixed rule as the prediction and their quantity as the score."""
    rows = table(spark, folder, "lineitem", *carry, "l_quantity", "l_returnflag")
    return rows.select(
        *carry,
        (F.col("l_quantity") > 25).cast("int").alias("prediction"),
        (F.col("l_returnflag") != "N").cast("int").alias("label"),
        (F.col("l_quantity") / 50).alias("score"),
    )


@query(
    "accuracy_of_rule",
    """
    SELECT count(*) AS n,
           avg(CASE WHEN (l_quantity > 25) = (l_returnflag <> 'N') THEN 1e0 ELSE 0e0 END) AS accuracy
    FROM lineitem
    """,
)
def accuracy_of_rule(spark: SparkSession, folder: str) -> DataFrame:
    return accuracy.accuracy(_judged(spark, folder), "prediction", "label", [])


@query(
    "group_propensity",
    """
    SELECT p_type AS state, count(*) AS n, count(*) FILTER (l_quantity > 25) / count(*) AS expected,
           count(*) FILTER (l_returnflag <> 'N') / count(*) AS actual
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type
    """,
)
def group_propensity(spark: SparkSession, folder: str) -> DataFrame:
    """Line items are summed per part before the parts are joined."""
    per_part = (
        _judged(spark, folder, "l_partkey")
        .groupBy("l_partkey")
        .agg(F.count("*").alias("n"), F.sum("prediction").alias("prediction"), F.sum("label").alias("label"))
    )
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("state"))
    joined = per_part.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return accuracy.propensity(joined, "state", "prediction", "label", F.col("n"))


SCORES_SQL = """
    WITH scores AS (
        SELECT l_quantity / 50 AS threshold, count(*) FILTER (l_returnflag <> 'N') AS pos,
               count(*) FILTER (l_returnflag = 'N') AS neg
        FROM lineitem GROUP BY 1),
    counts AS (
        SELECT threshold, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
               sum(pos) OVER () AS p, sum(neg) OVER () AS n
        FROM scores WINDOW w AS (ORDER BY threshold DESC)),
    sweep AS (
        SELECT threshold, tp, fp, tp / (tp + fp) AS precision, tp / p AS recall,
               2 * tp / (tp + fp + p) AS f_measure
        FROM counts)
"""


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    return accuracy.threshold_counts(_judged(spark, folder), "score", "label")


@query("threshold_sweep", SCORES_SQL + "SELECT threshold, tp, fp, precision, recall, f_measure FROM sweep")
def threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return accuracy.threshold_sweep(_counts(spark, folder))


@query(
    "best_threshold",
    SCORES_SQL + "SELECT threshold, f_measure FROM sweep ORDER BY f_measure DESC, threshold DESC LIMIT 1",
)
def best_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return accuracy.best_threshold(accuracy.threshold_sweep(_counts(spark, folder)))


@query(
    "roc_curve",
    SCORES_SQL + "SELECT fp / n AS fpr, tp / p AS tpr FROM counts UNION ALL SELECT 0e0, 0e0",
)
def roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    return accuracy.roc_curve(_counts(spark, folder))


@query(
    "roc_curve_placed",
    SCORES_SQL + """
    SELECT fpr, tpr, row_number() OVER (ORDER BY fpr, tpr) AS place
    FROM (SELECT fp / n AS fpr, tp / p AS tpr FROM counts UNION ALL SELECT 0e0, 0e0)
    """,
)
def roc_curve_placed(spark: SparkSession, folder: str) -> DataFrame:
    """The points of the curve with their place along it."""
    return placed(roc_curve(spark, folder), F.col("fpr"), F.col("tpr"))


@query("area_under_roc", SCORES_SQL + "SELECT sum(neg * (tp - pos / 2)) / (max(p) * max(n)) AS auc FROM counts")
def area_under_roc(spark: SparkSession, folder: str) -> DataFrame:
    return accuracy.area_under_roc(_counts(spark, folder))
