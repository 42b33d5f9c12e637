"""Every registered query against DuckDB: same columns, same types, equal values."""

from __future__ import annotations

import pytest
from conftest import FOLDER, rows_of

from __spark_entry__ import entry
from almanac.plans import oracles as oracle_sql, queries

TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}
ROWS_ONLY = sorted(set(queries()) - set(oracle_sql()))


@pytest.fixture(scope="module")
def collected(spark):
    """Rows of a query that fits a model, fitted once for all tests."""
    known = {}

    def rows(name):
        if name not in known:
            known[name] = queries()[name](spark, FOLDER).collect()
        return known[name]

    return rows


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    frame = queries()[name](spark, FOLDER)
    expected = duck.sql(oracle_sql()[name])
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {column: TYPES[kind] for column, kind in frame.dtypes} == types
    columns = sorted(types)
    wanted = expected.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    wanted.sort(key=lambda row: tuple((value is None, 0 if value is None else value) for value in row))
    assert rows_of(frame, *columns) == wanted
    assert wanted


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_model_query_gives_rows(collected, name):
    assert collected(name)
    assert all(value is not None for row in collected(name) for value in row)


@pytest.mark.parametrize("name", ["classify_gbt", "classify_forest", "classify_logistic"])
def test_classifiers_judge_every_row(collected, duck, name):
    found = {r.part: r for r in collected(name)}
    [(n, majority)] = duck.execute(
        "SELECT count(*), avg(CASE WHEN l_returnflag <> 'N' THEN 1e0 ELSE 0e0 END) "
        "FROM lineitem JOIN part ON l_partkey = p_partkey"
    ).fetchall()
    assert found["train"].n + found["test"].n == n
    assert 0.75 < found["train"].n / n < 0.85
    # Return flags do not depend on the features, so no model can do much better or worse than the majority.
    assert all(abs(r.accuracy - majority) < 0.06 for r in found.values())


def test_forest_forecast_slices_add_up(collected, duck):
    found = {r.slice: r for r in collected("forecast_forest")}
    assert found["all"].n == found["true"].n + found["false"].n
    pooled = sum(found[s].n * found[s].mape for s in ("true", "false")) / found["all"].n
    assert found["all"].mape == pytest.approx(pooled)
    [(n,)] = duck.execute(f"SELECT count(*) FROM ({oracle_sql()['weekly_lags']})").fetchall()
    assert 0.1 < found["all"].n / n < 0.3


def test_forest_folds_are_all_there(collected, duck):
    found = sorted((r.fold_year, r.half) for r in collected("walk_forward_forest"))
    wanted = duck.execute(
        f"SELECT DISTINCT fold_year, half FROM ({oracle_sql()['walk_forward_folds']}) ORDER BY 1, 2"
    ).fetchall()
    assert found == wanted


def test_entry(spark):
    assert entry(spark).count() == 12
