"""Corpus queries that SQL can express against DuckDB, on the given tables."""

from __future__ import annotations

import pytest
from conftest import FOLDER, rows_of

from almanac.llm.registry import oracles, queries

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.mark.parametrize("name", sorted(oracles()))
def test_matches_sql(spark, duck, name):
    frame = queries()[name](spark, FOLDER)
    expected = duck.execute(oracles()[name])
    names = [d[0] for d in expected.description]
    wanted = [dict(zip(names, row)) for row in expected.fetchall()]
    columns = sorted(frame.columns)
    assert sorted(names) == columns
    ordered = sorted(
        (tuple(row[c] for c in columns) for row in wanted),
        key=lambda row: tuple((value is None, 0 if value is None else value) for value in row),
    )
    assert rows_of(frame, *columns) == ordered and ordered


def test_every_operator_is_registered():
    names = list(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14)) and "pipeline" in names
