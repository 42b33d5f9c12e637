"""The file jobs end to end on small generated files."""

from __future__ import annotations

import datetime
import random

import pytest

from almanac import jobs
from almanac.operators.lines import SLICE_TITLES
from almanac.sources.delimited import BAR_VARIABLES


@pytest.fixture(scope="module")
def sql(files):
    """DuckDB over the same incident file."""
    connection = pytest.importorskip("duckdb").connect()
    connection.execute(
        f"""
        CREATE VIEW incidents AS
        SELECT * EXCLUDE (Date, Year), TRY_CAST(Year AS INTEGER) AS year,
               try_strptime(Date, '%m/%d/%Y %I:%M:%S %p') AS time
        FROM read_csv('{files}/incidents.csv', all_varchar = true, header = true) WHERE ID <> 'ID'
        """
    )
    return lambda query: connection.execute(query).fetchall()


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    random.seed(1)
    lines = ["ID,Date,Block,Beat,Community Area,Arrest,Year"]
    for i in range(6000):
        when = datetime.datetime(2008, 1, 1) + datetime.timedelta(hours=random.randint(0, 24 * 365 * 13 - 1))
        beat = random.choice(["0111", "0222", "0333"])
        lines.append(
            f'{i},{when:%m/%d/%Y %I:%M:%S %p},"{random.randint(0, 20):03d}XX N ""A"" ST, REAR",{beat},'
            f"{int(beat) % 4},{random.choice(['true', 'false'])},{when.year}"
        )
        if i == 3000:
            lines.append(lines[0])
    (folder / "incidents.csv").write_text("\n".join(lines) + "\n")
    (folder / "areas.csv").write_text("CommunityNo,Area_km2\n" + "".join(f"{i},{i + 0.5}\n" for i in range(4)))
    inspections = ["truck_number_one,basic,time_weight"]
    inspections += [f"t{i % 30},{'x' if i % 30 < 12 else ''},{i % 30 + i % 2}" for i in range(900)]
    (folder / "inspections.csv").write_text("\n".join(inspections) + "\n")
    fleet = ["truck_number,purchase_price,model_year,state,manufacturer"]
    fleet += [f"t{i},{1000 + i},{2000 + i % 5},S{i % 3},M{i % 4}" for i in range(30)]
    (folder / "fleet.csv").write_text("\n".join(fleet) + "\n")
    bars = [",".join(("trade_id", "time_stamp", "bar_num", "profit", *BAR_VARIABLES))]
    for trade in range(30):
        for bar in range(1, 61):
            when = datetime.datetime(2008, 1, 5) + datetime.timedelta(days=12 * bar + trade % 10)
            values = [str(random.randint(0, 9)) for _ in BAR_VARIABLES]
            bars.append(f"{trade},{when:%Y-%m-%d %H:%M:%S},{bar},{bar + random.random()},{','.join(values)}")
    (folder / "bars.csv").write_text("\n".join(bars) + "\n")
    return folder


def lines(folder, name):
    return [line for part in sorted((folder / name).glob("part-*")) for line in part.read_text().splitlines()]


def run(spark, files, tmp_path, job, *inputs, **options):
    arguments = [job, "--output", str(tmp_path)]
    for name in inputs:
        arguments += [f"--{name}", str(files / f"{name}.csv")]
    for name, value in options.items():
        arguments += [f"--{name}", str(value)]
    jobs.run(spark, jobs.parser().parse_args(arguments))


def test_seasonal(spark, files, sql, tmp_path):
    run(spark, files, tmp_path, "seasonal", "incidents")
    rows = [line.split(",") for line in lines(tmp_path, "seasonal") if not line.startswith("month")]
    wanted = sql(
        "SELECT m, avg(n) FROM (SELECT year, month(time) AS m, count(DISTINCT ID) AS n FROM incidents GROUP BY 1, 2) "
        "GROUP BY m ORDER BY m"
    )
    assert [(int(m), float(n)) for m, n in rows] == wanted and len(wanted) == 12


def test_top_blocks(spark, files, sql, tmp_path):
    run(spark, files, tmp_path, "top-blocks", "incidents")
    found = lines(tmp_path, "top_blocks")
    wanted = sql(
        "SELECT Block, count(*) AS n FROM incidents WHERE year >= (SELECT max(year) - 2 FROM incidents) "
        "GROUP BY Block ORDER BY n DESC, Block LIMIT 10"
    )
    assert found == [f"{block},{n}" for block, n in wanted] and '"A" ST, REAR,' in found[0]


def test_beat_correlation(spark, files, sql, tmp_path):
    run(spark, files, tmp_path, "beat-correlation", "incidents")
    found = [line.split(": ") for line in lines(tmp_path, "beat_correlation")]
    wanted = {
        f"{a},{b}": corr
        for a, b, corr in sql(
            """
            WITH n AS (SELECT Beat, year, count(*) AS n FROM incidents
                       WHERE year >= (SELECT max(year) - 4 FROM incidents) GROUP BY 1, 2)
            SELECT a.Beat, b.Beat, corr(a.n, b.n) FROM n a JOIN n b ON a.year = b.year AND a.Beat < b.Beat
            GROUP BY 1, 2
            """
        )
    }
    assert {pair: float(value) for pair, value in found} == pytest.approx(wanted) and len(wanted) == 3
    strengths = [abs(float(value)) for _, value in found]
    assert strengths == sorted(strengths, reverse=True) and max(strengths) <= 1


def test_welch_and_chi_square(spark, files, sql, tmp_path):
    run(spark, files, tmp_path, "welch", "incidents")
    header, row = [line.split(",") for line in lines(tmp_path, "welch")]
    found = dict(zip(header, row))
    [(t,)] = sql(
        """
        WITH y AS (SELECT year, count(*) AS n FROM incidents WHERE year < 2020 GROUP BY 1)
        SELECT (avg(n) FILTER (year >= 2011) - avg(n) FILTER (year < 2011))
               / sqrt(var_samp(n) FILTER (year >= 2011) / 9 + var_samp(n) FILTER (year < 2011) / 3)
        FROM y
        """
    )
    assert (found["n0"], found["n1"]) == ("3", "9") and float(found["t"]) == pytest.approx(t)
    run(spark, files, tmp_path, "chi-square", "incidents")
    header, row = [line.split(",") for line in lines(tmp_path, "chi_square")]
    assert header == ["statistic", "dof", "p_value"] and 0 < float(row[2]) <= 1


def test_forecasts(spark, files, tmp_path):
    run(spark, files, tmp_path, "linear-forecast", "incidents")
    run(spark, files, tmp_path, "forest-forecast", "incidents", "areas")
    for name in ("linear_forecast", "forest_forecast"):
        found = dict(line.split(": ") for line in lines(tmp_path, name))
        assert set(found) == set(SLICE_TITLES.values())
        assert all(0 < float(value) < 200 for value in found.values())


def test_arrest_profiles(spark, files, sql, tmp_path):
    run(spark, files, tmp_path, "arrest-profiles", "incidents")
    rows = [line.split(",") for line in lines(tmp_path, "arrest_profiles") if not line.startswith("part")]
    wanted = []
    for part, value in (("month", "month(time)"), ("weekday", "dayofweek(time) + 1"), ("hour", "hour(time)")):
        wanted += sql(f"SELECT '{part}', {value}, count(ID) FROM incidents WHERE Arrest = 'true' GROUP BY 2")
    assert [(p, int(v), int(n)) for p, v, n in rows] == sorted(wanted) and len(wanted) == 12 + 7 + 24


@pytest.mark.parametrize("kind", ["forest", "logistic"])
def test_inspections(spark, files, tmp_path, kind):
    run(spark, files, tmp_path, "inspections", "inspections", "fleet", kind=kind)
    rows = [line.split(",") for line in lines(tmp_path, "accuracy") if not line.startswith("part")]
    # The threshold is the best one on the training rows, which a logistic model of few rows separates wholly.
    least = {"forest": 0.9, "logistic": 0.65}[kind]
    assert sum(int(n) for _, n, _ in rows) == 900 and all(float(a) > least for _, _, a in rows), rows
    assert any("time_weight" in line for line in lines(tmp_path, "weights"))
    states = [line.split(",") for line in lines(tmp_path, "propensity") if not line.startswith("state")]
    assert {s for s, *_ in states} == {"S0", "S1", "S2"} and sum(int(n) for _, n, *_ in states) == 900
    if kind == "logistic":
        assert float(lines(tmp_path, "auc")[-1]) > 0.9
        assert len(lines(tmp_path, "best_threshold")) == 2
        # The header of each part aside, the curve has a point per threshold and the origin.
        points = {name: len([n for n in lines(tmp_path, name) if n[0].isdigit()]) for name in ("roc", "thresholds")}
        assert points["roc"] == points["thresholds"] + 1


def test_walk_forward(spark, files, tmp_path):
    run(spark, files, tmp_path, "walk-forward", "bars", first=2008, last=2009)
    found = lines(tmp_path, "walk_forward")
    assert [line.split(",")[0] for line in found[:3]] == [
        "First Half of Year 2008", "Second Half of Year 2008", "First Half of Year 2009",
    ]
    assert [line.split(":")[0] for line in found[3:]] == ["Average MAPE", "Minimum MAPE", "Maximum MAPE"]
