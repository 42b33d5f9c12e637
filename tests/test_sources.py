from __future__ import annotations

import datetime
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from almanac.functions import parse_time
from almanac.sources import files, staging
from almanac.sources import (
    Run,
    Stage,
    damage_report,
    fit_layout,
    incident_columns,
    materialise,
    owned_staging,
    publish,
    published,
    read_areas,
    read_checked,
    read_delimited,
    read_incidents,
    with_reason,
    write_delimited,
    write_lines,
)

ROOT = Path(__file__).resolve().parents[1]

HEADER = "ID,Date,Block,Beat,Community Area,Arrest,Year"


@pytest.fixture
def incidents(tmp_path):
    path = tmp_path / "incidents.csv"
    path.write_text(
        "\n".join(
            [
                HEADER,
                '1,01/31/2019 11:05:00 PM,"001XX, N ""A"" ST",0714,44,true,2019',
                "2,02/01/2019 12:00:00 AM,002XX,0825,44,false,2019",
                HEADER,
                "3,,003XX,0825,,maybe,x",
                "4,31/31/2019,004XX,0825,12,true,2020",
            ]
        )
        + "\n"
    )
    return str(path)


def test_incidents_are_typed_and_stray_lines_survive(spark, incidents):
    rows = rows_of(read_incidents(spark, incidents), "id", "block", "beat", "community", "arrest", "year")
    assert rows == [
        ("1", '001XX, N "A" ST', "0714", "44", True, 2019),
        ("2", "002XX", "0825", "44", False, 2019),
        ("3", "003XX", "0825", None, None, None),
        ("4", "004XX", "0825", "12", True, 2020),
    ]


def test_times_use_the_twelve_hour_clock_and_bad_ones_are_null(spark, incidents):
    rows = dict(rows_of(read_incidents(spark, incidents), "id", F.date_format("time", "yyyy-MM-dd HH:mm")))
    assert rows == {"1": "2019-01-31 23:05", "2": "2019-02-01 00:00", "3": None, "4": None}


def test_only_used_columns_are_parsed(spark, incidents):
    frame = read_incidents(spark, incidents).select("block", "year")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ID:string,Block:string,Year:string>" in plan


def test_header_is_dropped_only_if_every_value_matches(spark, tmp_path):
    path = tmp_path / "areas.csv"
    path.write_text("CommunityNo,Area_km2\n1,2.5\nCommunityNo,Area_km2\nCommunityNo,7\n2,big\n")
    assert rows_of(read_delimited(spark, str(path)), "CommunityNo", "Area_km2") == [
        ("1", "2.5"), ("2", "big"), ("CommunityNo", "7"),
    ]
    assert rows_of(read_areas(spark, str(path)), "community", "area") == [
        ("1", 2.5), ("2", None), ("CommunityNo", 7.0),
    ]


def test_another_order_of_columns_fails_loudly(spark, tmp_path):
    header = "ID,Date,Block,Beat,Community Area,Arrest,Year"
    (tmp_path / "a.csv").write_text(f"{header}\n1,01/01/2020 01:00:00 AM,b,0825,44,true,2020\n")
    (tmp_path / "b.csv").write_text(f"{header.replace('Beat,Community Area', 'Community Area,Beat')}\n2,x,b,44,0825,true,2020\n")
    both = read_incidents(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    with pytest.raises(Exception, match="(?i)header"):
        both.collect()


def test_materialise_keeps_rows_and_types(spark):
    rows = spark.range(100).select(
        "id", (F.col("id") % 3).cast("int").alias("year"), F.lit("x").alias("name"),
    )
    plain = materialise(rows, "test")
    assert plain.dtypes == rows.dtypes and rows_of(plain) == rows_of(rows)
    parted = materialise(rows, "test", ("year",))
    assert sorted(parted.dtypes) == sorted(rows.dtypes) and rows_of(parted) == rows_of(rows)
    one = parted.filter(F.col("year") == 1)
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 33


def test_fit_layout_does_not_depend_on_the_input_layout(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("hot"))
    placed = [
        [tuple(r) for r in fit_layout(rows.repartition(n), "hot", parts=5).withColumn("p", F.spark_partition_id()).collect()]
        for n in (2, 7)
    ]
    assert placed[0] == placed[1] and len({p for *_, p in placed[0]}) == 5


def test_staging_is_deleted_by_its_owner(spark, monkeypatch, tmp_path):
    assert staging.staging_base(spark) == spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    monkeypatch.setattr(staging, "staging_base", lambda _: str(tmp_path))
    with owned_staging(spark):
        materialise(spark.range(3), "a")
        assert [p.name[:2] for p in (tmp_path / "almanac").iterdir()] == ["a-"]
    assert not list((tmp_path / "almanac").iterdir())
    with pytest.raises(ValueError):
        with owned_staging(spark):
            materialise(spark.range(3), "b")
            raise ValueError
    assert not list((tmp_path / "almanac").iterdir())


def test_lines_keep_their_order(spark, tmp_path):
    path = str(tmp_path / "lines")
    write_lines(spark.range(1000, numPartitions=4).orderBy(F.desc("id")), F.col("id").cast("string"), path)
    lines = [line for part in sorted((tmp_path / "lines").glob("part-*")) for line in part.read_text().split()]
    assert lines == [str(i) for i in range(999, -1, -1)]


def test_parse_time_of_bars(spark):
    frame = spark.createDataFrame([("2008-01-02 03:04:05",), ("2008-13-01 00:00:00",)], "t string")
    parsed = frame.select(parse_time("t", "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    assert [row.t for row in parsed] == [datetime.datetime(2008, 1, 2, 3, 4, 5), None]


def _killed_run(folder: str, source: str, marks: str, fail: bool) -> str:
    """A script of a run of four stages; each leaves a mark when it is made, and the last may end its process."""
    return f"""
import os, sys
sys.path.insert(0, {str(ROOT)!r})
from almanac.session import build_session
from almanac.sources import Run, Stage
spark = build_session("run", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
def stage(name, *inputs):
    def build(*tables):
        open(os.path.join({marks!r}, name), "a").write("x")
        if name == "four" and {fail}:
            os._exit(9)
        rows = tables[0]
        for other in tables[1:]:
            rows = rows.unionByName(other)
        return rows.selectExpr("id + 1 AS id")
    return Stage(name, build, inputs)
stages = [stage("one", "base"), stage("two", "one"), stage("three", "two"), stage("four", "three", "two")]
run = Run(spark, {folder!r}, stages, {{"base": {source!r}}})
print("RESULT", sorted(r.id for r in run.result().collect()))
print("LEFT", sorted(n.split("-")[0] for n in os.listdir({folder!r}) if not n.startswith(".")))
if len(sys.argv) > 1:
    run.close()
"""


def test_a_killed_run_goes_on_where_it_stopped(spark, tmp_path):
    source, folder, marks = str(tmp_path / "base"), str(tmp_path / "run"), tmp_path / "marks"
    marks.mkdir()
    spark.range(3).write.parquet(source)

    def start(fail, *arguments):
        script = _killed_run(folder, source, str(marks), fail)
        done = subprocess.run([sys.executable, "-c", script, *arguments], capture_output=True, text=True, timeout=300)
        return done.returncode, done.stdout, {p.name: len(p.read_text()) for p in marks.iterdir()}

    code, _, made = start(True)
    assert code == 9 and made == {"one": 1, "two": 1, "three": 1, "four": 1}
    code, said, made = start(False)
    # Only the stage that was cut off is made again, from the tables of the others.
    assert code == 0 and made == {"one": 1, "two": 1, "three": 1, "four": 2}
    assert "RESULT [3, 4, 4, 5, 5, 6]" in said and "LEFT ['four', 'manifest']" in said
    code, said, made = start(False)
    assert made["four"] == 2 and "RESULT [3, 4, 4, 5, 5, 6]" in said
    spark.range(2).write.mode("overwrite").parquet(source)
    code, said, made = start(False, "close")
    assert made == {"one": 2, "two": 2, "three": 2, "four": 3} and "RESULT [3, 4, 4, 5]" in said
    assert not (tmp_path / "run").exists()


def test_tables_go_when_their_last_reader_has_ended(spark, tmp_path):
    seen = {}

    def build(name):
        def made(*tables):
            seen[name] = sorted(p.name.split("-")[0] for p in (tmp_path / "run").iterdir()) if (tmp_path / "run").exists() else []
            return tables[0]
        return made

    spark.range(3).write.parquet(str(tmp_path / "base"))
    inputs = {"a": ("base",), "b": ("a",), "c": ("b", "a"), "d": ("c",)}
    run = Run(spark, str(tmp_path / "run"), [Stage(n, build(n), i) for n, i in inputs.items()], {"base": str(tmp_path / "base")})
    assert run.result().count() == 3
    assert seen == {"a": [], "b": ["a", "manifest"], "c": ["a", "b", "manifest"], "d": ["c", "manifest"]}
    assert run.state("a") == "released" and run.state("d") == "done"
    # Another version of a stage runs it and what comes after, and what those read.
    later = [Stage(n, build(n), i, "2" if n == "d" else "1") for n, i in inputs.items()]
    seen.clear()
    assert Run(spark, str(tmp_path / "run"), later, run.sources).result().count() == 3
    assert sorted(seen) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError):
        Run(spark, str(tmp_path / "x"), [Stage("a", build("a"), ("none",))])


@pytest.fixture
def mounted(spark, conf, tmp_path):
    """A second file system scheme, which only Hadoop's readers and writers can open."""
    (tmp_path / "store").mkdir()
    conf(**{"fs__viewfs__mounttable__own__link__/bucket": f"file://{tmp_path}/store"})
    return "viewfs://own/bucket"


def test_delimited_files_of_another_file_system(spark, mounted, incidents):
    rows = spark.read.text(incidents)
    rows.coalesce(1).write.text(f"{mounted}/incidents")
    assert rows_of(read_incidents(spark, f"{mounted}/incidents"), "id", "year") == rows_of(read_incidents(spark, incidents), "id", "year")
    lines = spark.range(5).select(F.col("id").cast("string").alias("v"))
    write_lines(lines, F.col("v"), f"{mounted}/lines")
    assert rows_of(spark.read.text(f"{mounted}/lines"), "value") == [(str(i),) for i in range(5)]


def test_half_a_table_is_never_published(spark, mounted):
    path = f"{mounted}/table"
    with pytest.raises(FileNotFoundError):
        published(spark, path)
    rows = spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("v"))
    failing = rows.withColumn("v", F.when(F.col("v") == "99", F.raise_error(F.lit("lost"))).otherwise(F.col("v")))

    def now():
        return read_delimited(spark, published(spark, path)).count()

    with pytest.raises(Exception, match="lost"):
        publish(failing, path, write_delimited)
    with pytest.raises(FileNotFoundError):
        published(spark, path)
    publish(rows, path, write_delimited)
    first = published(spark, path)
    assert now() == 100
    with pytest.raises(Exception, match="lost"):
        publish(failing, path, write_delimited)
    assert published(spark, path) == first and now() == 100
    publish(rows.limit(7), path, write_delimited)
    assert now() == 7 and read_delimited(spark, first).count() == 100  # its readers may go on
    publish(rows.limit(3), path, write_delimited)
    assert now() == 3 and len([n for n in files.names(spark, path) if n.startswith("version-")]) == 2


def test_damaged_lines_are_kept_and_counted(spark, tmp_path):
    path = tmp_path / "incidents.csv"
    good = "1,01/31/2019 11:05:00 PM,b,0714,44,true,2019"
    lines = [HEADER, good, "2,01/31/2019", good + ",more", HEADER, good.replace("2019", "MMXIX"), "3,,b,0714,,,", '4,"x', ""]
    path.write_text("\n".join(lines) + "\n")
    checked = with_reason(read_checked(spark, str(path), probe=("ID",)), incident_columns())
    assert rows_of(checked.filter("damaged IS NOT NULL"), "damaged") == sorted([("2,01/31/2019",), (good + ",more",), ('4,"x',)])
    assert rows_of(damage_report(checked), "reason", "n") == [("fields", 3), ("sound", 2), ("values", 1)]
