"""The analyses as jobs over delimited files.

``spark-submit jobs.py <job> --output <folder> ...`` or ``python -m almanac.jobs``. Each job is also a
function from a session and paths to DataFrames.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import with_calendar
from almanac.models import classify, forecast, walkforward
from almanac.models.pipelines import coefficients, feature_importances
from almanac.operators import accuracy, contrasts, correlation, counts, density, folds, recency
from almanac.operators.bars import SUMMARIES, with_previous_group
from almanac.operators.classes import label_features, with_part
from almanac.operators.lines import fold_lines, pair_line, slice_line
from almanac.session import build_session
from almanac.sources import (
    materialise,
    owned_staging,
    read_areas,
    read_bars,
    read_fleet,
    read_incidents,
    read_inspections,
    write_delimited,
    write_lines,
)
from almanac.sources.delimited import BAR_VARIABLES


def seasonal(spark: SparkSession, incidents: str) -> DataFrame:
    """Average number of incidents per calendar month: month, avg_count."""
    return counts.seasonal_average(read_incidents(spark, incidents), "id", F.col("year"), F.month("time"))


def _yearly_by(spark: SparkSession, incidents: str, key: str) -> DataFrame:
    """Incidents per key and year, written, so that the text is read once. An empty key is a key."""
    rows = read_incidents(spark, incidents).select(key, "year").na.fill("", [key])
    return materialise(rows.groupBy(key, "year").agg(F.count("*").alias("n")), "yearly")


def top_blocks(spark: SparkSession, incidents: str, years: int = 3, k: int = 10) -> DataFrame:
    """Blocks with most incidents in the last years: block, n."""
    yearly_counts = _yearly_by(spark, incidents, "block")
    return recency.top_keys(recency.recent_years(yearly_counts, "year", years), "block", k, F.col("n"))


def beat_correlation(spark: SparkSession, incidents: str, years: int = 5) -> DataFrame:
    """Correlation of the yearly counts of every pair of beats: key1, key2, corr."""
    yearly_counts = _yearly_by(spark, incidents, "beat")
    latest = recency.latest_year(yearly_counts, "year")
    vectors = density.year_vectors(yearly_counts, "beat", "year", F.col("n"), latest, years)
    return correlation.pairwise_correlation(vectors, "beat", years)


# fixed values: the years 2011 and 2020 here, 2008 and 2015 below
def yearly(spark: SparkSession, incidents: str, split: int = 2011, end: int = 2020) -> DataFrame:
    """Counts of the years before ``end``, labelled by whether the split has passed: year, n, label."""
    rows = read_incidents(spark, incidents).filter(F.col("year") < end)
    return contrasts.yearly_counts(rows, F.col("year"), split)


def welch(spark: SparkSession, incidents: str, split: int = 2011, end: int = 2020) -> DataFrame:
    return contrasts.welch_t(yearly(spark, incidents, split, end), "n", "label")


def chi_square(spark: SparkSession, incidents: str, split: int = 2011, end: int = 2020) -> DataFrame:
    return contrasts.chi_square_test(yearly(spark, incidents, split, end), "n", "label")


def forest_forecast(spark: SparkSession, incidents: str, areas: str) -> DataFrame:
    """Error of the forest forecast of next week's count: slice, n, mape."""
    rows = read_incidents(spark, incidents)
    fine = counts.weekly_counts(rows, ["beat", "community"], "id", "time", F.col("arrest"))
    placed = fine.join(read_areas(spark, areas), "community", "left")
    weekly = counts.sum_counts(placed, ["beat", "year", "week", "area"], ["crimes", "arrests"])
    flagged = counts.with_majority_flag(weekly)
    lagged = counts.with_lags(flagged, ["beat"], ["year", "week", "area"], "crimes", 4, "next_week")
    features = materialise(with_part(lagged, ["beat", "year", "week", "area"]), "forest")
    return forecast.forest_errors(forecast.fit_forest(features), features)


def linear_forecast(spark: SparkSession, incidents: str) -> DataFrame:
    """Error of the linear forecast, also on the series with and without arrest: slice, n, mape."""
    rows = read_incidents(spark, incidents)
    by_arrest = materialise(counts.weekly_counts(rows, ["beat", "arrest"], "id", "time"), "weekly")
    weekly = counts.sum_counts(by_arrest, ["beat", "year", "week"], ["crimes"])
    order = ["year", "week"]
    lagged = counts.with_lags(weekly, ["beat"], order, "crimes", 2, "next_week")
    features = materialise(with_part(lagged, ["beat", *order]), "linear")
    split = counts.with_lags(by_arrest, ["beat", "arrest"], order, "crimes", 2, "next_week")
    return forecast.linear_errors(forecast.fit_linear(features), features, split)


def arrest_profiles(spark: SparkSession, incidents: str) -> DataFrame:
    """Arrests by month, weekday and hour: part, value, n."""
    arrests = read_incidents(spark, incidents).filter("arrest")
    return counts.calendar_profiles(arrests, "id", "time", ("month", "weekday", "hour"))


def inspections(
    spark: SparkSession, inspections: str, fleet: str, kind: str = "gbt", k: int = 8
) -> dict[str, DataFrame]:
    """Fit a classifier and report on it, by name of the result:

    accuracy per part; weights, the k most important features or all coefficients; propensity, the expected
    and actual share of violations per state; and for logistic regression, on its training rows, thresholds,
    best_threshold, roc and auc.

    There is no row key, so the parts are drawn by whole rows: equal rows never sit on both sides.
    """
    rows = label_features(
        read_inspections(spark, inspections), read_fleet(spark, fleet), "truck_number_one", "truck_number"
    )
    complete = classify.complete_rows(rows)
    features, index = classify.encoded(materialise(with_part(complete, complete.columns), "classes"))
    model = classify.fit(features, kind, index)
    features = model.encode(features)
    results = {
        "accuracy": (
            classify.threshold_accuracy(model, features).drop("threshold") if kind == "logistic"
            else classify.part_accuracy(model, features)
        ),
        "weights": coefficients(model, features) if kind == "logistic" else feature_importances(model, k),
        "propensity": accuracy.propensity(model.transform(features), "state", "prediction", "label"),
    }
    if kind == "logistic":
        scored = classify.with_score(model, features.filter(F.col("part") == "train"))
        scores = accuracy.threshold_counts(scored, "score", "label")
        sweep = accuracy.threshold_sweep(scores)
        results |= {
            "thresholds": sweep,
            "best_threshold": accuracy.best_threshold(sweep),
            "roc": accuracy.roc_curve(scores),
            "auc": accuracy.area_under_roc(scores),
        }
    return results


def walk_forward(spark: SparkSession, bars: str, first: int = 2008, last: int = 2015) -> DataFrame:
    """Error of a forest per half-year fold: fold_year, half, mape.

    The folds are those from ``first`` to the first half of ``last`` that have rows to train on and to test on. The
    bars are written in typed columns first, since the join of neighbouring groups reads them twice.
    """
    typed = materialise(read_bars(spark, bars), "bars")
    rows = with_calendar(with_previous_group(typed), "time", "year", "month")
    features = [*BAR_VARIABLES, *SUMMARIES]
    months = walkforward.stage_months(rows, features, "profit")
    present = set(folds.present_folds(months))
    chosen = [fold for fold in folds.half_years(first, last) if fold in present]
    return walkforward.forest_errors(months, features, "profit", chosen)


@dataclass(frozen=True)
class Job:
    """Inputs of a job, its results by name, and the text line of a result that is written as lines."""

    inputs: tuple[str, ...]
    results: Callable[[SparkSession, argparse.Namespace], dict[str, DataFrame]]
    line: Callable[[], Column] | None = None


JOBS = {
    "seasonal": Job(("incidents",), lambda spark, o: {"seasonal": seasonal(spark, o.incidents)}),
    "top-blocks": Job(
        ("incidents",),
        lambda spark, o: {"top_blocks": top_blocks(spark, o.incidents)},
        lambda: F.concat_ws(",", "block", "n"),
    ),
    "beat-correlation": Job(
        ("incidents",), lambda spark, o: {"beat_correlation": beat_correlation(spark, o.incidents)}, pair_line
    ),
    "welch": Job(("incidents",), lambda spark, o: {"welch": welch(spark, o.incidents)}),
    "chi-square": Job(("incidents",), lambda spark, o: {"chi_square": chi_square(spark, o.incidents)}),
    "linear-forecast": Job(
        ("incidents",), lambda spark, o: {"linear_forecast": linear_forecast(spark, o.incidents)}, slice_line
    ),
    "forest-forecast": Job(
        ("incidents", "areas"),
        lambda spark, o: {"forest_forecast": forest_forecast(spark, o.incidents, o.areas)},
        slice_line,
    ),
    "arrest-profiles": Job(
        ("incidents",), lambda spark, o: {"arrest_profiles": arrest_profiles(spark, o.incidents)}
    ),
    "inspections": Job(
        ("inspections", "fleet"), lambda spark, o: inspections(spark, o.inspections, o.fleet, o.kind)
    ),
    "walk-forward": Job(
        ("bars",),
        lambda spark, o: {
            "walk_forward": fold_lines(materialise(walk_forward(spark, o.bars, o.first, o.last), "folds"))
        },
        lambda: F.col("line"),
    ),
}


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    """Run a job and write its results below the output folder. Nothing that it staged is left behind."""
    job = JOBS[options.job]
    with owned_staging(spark):
        for name, result in job.results(spark, options).items():
            path = f"{options.output.rstrip('/')}/{name}"
            if job.line is None:
                write_delimited(result, path)
            else:
                write_lines(result, job.line(), path)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="almanac", description="Run one of the analyses over delimited files.")
    commands = root.add_subparsers(dest="job", required=True)
    added = {}
    for name, job in JOBS.items():
        added[name] = commands.add_parser(name)
        for item in (*job.inputs, "output"):
            added[name].add_argument(f"--{item}", required=True)
    added["inspections"].add_argument("--kind", default="gbt", choices=("gbt", "forest", "logistic"))
    added["walk-forward"].add_argument("--first", type=int, default=2008)
    added["walk-forward"].add_argument("--last", type=int, default=2015)
    return root


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = build_session(f"almanac-{options.job}")
    run(spark, options)


if __name__ == "__main__":
    main()
