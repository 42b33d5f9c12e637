"""Joins whose facts may hold a large part of all rows in a few keys.

The engine splits a hot key at run time if a partition passes its size limits, and only in a plain join. Here hot keys are
known before: a frequent-items sketch, a Misra-Gries summary that tasks build and merge, lists every key above a share of
the rows. Facts of a hot key are dealt to as many salts as its share asks for, and its dimension rows are repeated for
each; all other keys have one salt, so it stays one plain join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parts of a mean task that the rows of a hot key are cut to, so that parts that meet by chance weigh little.
GRAIN = 8


def _item(keys: list[str]) -> Column:
    """What the sketch counts: the key itself, or a hash of several."""
    return F.col(keys[0]) if len(keys) == 1 else F.xxhash64(*keys)


def sketch(rows: DataFrame, item: Column, share: float) -> DataFrame:
    """One row: hot, an array of item and count that has every item with at least ``share`` of the rows, and total.

    The summary keeps m items and errs by at most 3.5 / m of the rows, either way, and lists those that are above that
    error for certain; 16 / share items leave room. Counts are estimates, and some items below the share are listed too.
    """
    tracked = 1 << max(int(16 / share) - 1, 64).bit_length()
    listed = min(int(2 / share) + 2, tracked)
    named = rows.select(item.alias("item")).filter("item IS NOT NULL")
    return named.agg(F.expr(f"approx_top_k(item, {listed}, {tracked})").alias("hot"), F.count("*").alias("total"))


def heavy_keys(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Keys that hold at least ``share`` of the rows whose key is not null, and exactly how many: the keys, n.

    The sketch, built in one pass, proposes at most 2 / share + 2 keys; a second pass counts just those.
    """
    found = sketch(rows, _item(keys), share)
    proposed = found.select(F.transform("hot", lambda h: h["item"]).alias("items")).scalar()
    total = found.select("total").scalar()
    known = rows.filter(F.array_contains(proposed, _item(keys)))
    return known.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") >= F.lit(share) * total)


def spread_join(
    facts: DataFrame, dimension: DataFrame, fact_keys: list[str], dimension_keys: list[str], how: str = "inner",
    parts: int | None = None,
) -> DataFrame:
    """Inner or left join on equal keys, all columns of both sides, in which no key's facts meet in one task.

    ``parts`` is the number of tasks to spread over, by default the shuffle partitions. A key counts as hot from a share of
    half a task. Facts with a null key match nothing; in a left join they are kept, and spread too.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a spread join keeps facts, so it is inner or left, not {how!r}")
    parts = parts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = sketch(facts, _item(fact_keys), 1 / (2 * parts))
    grains = F.ceil(F.lit(parts * GRAIN) * F.col("count") / F.col("total")).cast("int")
    hot = (
        found.select("total", F.inline("hot").alias("item", "count")).filter(F.col("count") * (2 * parts) >= F.col("total"))
        .agg(F.map_from_entries(F.collect_list(F.struct("item", grains.alias("salts"))))).scalar()
    )

    def salts(keys: list[str]) -> Column:
        return F.coalesce(F.try_element_at(hot, _item(keys)), F.lit(1))

    nothing = F.lit(False)
    for key in fact_keys:
        nothing = nothing | F.col(key).isNull()
    own = F.when(nothing, F.lit(parts * GRAIN)).otherwise(salts(fact_keys))
    salted = facts.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), own).cast("int"))
    names = [f"_key_{i}" for i in range(len(dimension_keys))]
    repeated = dimension.withColumns({
        **{n: F.col(k) for n, k in zip(names, dimension_keys)},
        "_copy": F.explode(F.sequence(F.lit(0), salts(dimension_keys) - 1)),
    })
    same = F.col("_salt") == F.col("_copy")
    for key, name in zip(fact_keys, names):
        same = same & (F.col(key) == F.col(name))
    return salted.join(repeated, same, how).drop("_salt", "_copy", *names)
