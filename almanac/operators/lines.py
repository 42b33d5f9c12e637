"""Lines of the text reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.operators.folds import fold_summary

# The wording of the text reports.
SLICE_TITLES = {
    "all": "Overall MAPE",
    "true": "MAPE for Violent Crimes",
    "false": "MAPE for non-Violent Crimes",
}
FOLD_LINE = "%s Half of Year %d, MAPE: %.2f"
SUMMARY_LINE = "%s MAPE: %.2f"


def slice_line() -> Column:
    title = F.create_map(*[F.lit(text) for pair in SLICE_TITLES.items() for text in pair])[F.col("slice")]
    return F.concat_ws(": ", title, F.col("mape").cast("string"))


def fold_lines(errors: DataFrame) -> DataFrame:
    """One line per fold in order, then the average, minimum and maximum."""
    per_fold = errors.select(
        (F.col("fold_year") * 2 + F.col("half")).alias("place"),
        F.format_string(
            FOLD_LINE, F.when(F.col("half") == 1, "First").otherwise("Second"), "fold_year", "mape",
        ).alias("line"),
    )
    names = ("Average", "Minimum", "Maximum")
    summary = fold_summary(errors).select(
        F.posexplode(F.array(*[F.format_string(SUMMARY_LINE, F.lit(n), n.lower()) for n in names])).alias("i", "line")
    )
    after_all_folds = F.lit(2 * 10_000)
    summary = summary.select((after_all_folds + F.col("i")).alias("place"), "line")
    return per_fold.unionByName(summary).orderBy("place").select("line")


def pair_line() -> Column:
    return F.concat("key1", F.lit(","), "key2", F.lit(": "), F.col("corr").cast("string"))
