"""Exports read in ranges of a few bytes equal the one-task read."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from granary.sources import exports, scans


@pytest.fixture(params=[8, 40, 1 << 20])
def ranged(spark, request):
    """A session that cuts files every few bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    held = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "0")
    yield request.param
    for n, v in held.items():
        spark.conf.set(n, v)


def whole(spark, path):
    """All cells, each file read by one task."""
    return spark.read.options(**exports.OPTIONS).csv(path)


def cells(df):
    return sorted(tuple(v or "" for v in r) for r in df.collect())


def written(path, header, rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([header, *rows])
    path.write_bytes(out.getvalue().encode())
    return rows


def odd(rng):
    return "".join(rng.choice(['"', '""', ",", "\n", "a", "bc", " ", "é", '"\n"', "\n\n", ""]) for _ in range(rng.randrange(0, 9)))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quotes_and_breaks_across_borders(spark, tmp_path, ranged, end):
    rng = random.Random(ranged)
    rows = written(tmp_path / "a.csv", ["Name", "Notes", "Unit (kg)"], [(f"r{i}", odd(rng), odd(rng)) for i in range(30)], end)
    path = str(tmp_path / "a.csv")
    got = scans.read_export(spark, path)
    assert got.columns == ["name", "notes", "unit_kg"]
    assert cells(got) == cells(whole(spark, path)) == sorted(rows)
    if ranged == 8:
        assert exports._lines(spark, path).select("begin").distinct().count() > 5


def test_a_cell_over_many_ranges(spark, tmp_path, ranged):
    rows = written(tmp_path / "a.csv", ["a", "b"], [("1", "x\n" * 200), ("2", "plain"), ("3", 'y"\n' * 100), ("4", "")])
    assert cells(exports.read(spark, str(tmp_path / "a.csv"), True)) == sorted(rows)


def test_several_files(spark, tmp_path, ranged):
    rng = random.Random(1)
    rows = [r for k in range(3) for r in written(tmp_path / f"{k}.csv", ["a", "b"], [(f"{k}.{i}", odd(rng)) for i in range(5)])]
    (tmp_path / "0.csv").write_bytes(b"\xef\xbb\xbf" + (tmp_path / "0.csv").read_bytes())
    got = exports.read(spark, str(tmp_path), True)
    assert got.columns == ["a", "b"] and cells(got) == sorted(rows)
    written(tmp_path / "3.csv", ["b", "a"], [("1", "2")])
    with pytest.raises(ValueError, match="different headers"):
        exports.read(spark, str(tmp_path), True)
    assert exports.read(spark, str(tmp_path), False).count() == 16


def test_broken_files_stop_the_job(spark, tmp_path, ranged):
    for body in ('x,"open\ny,z\n', "x\n", "x,y,z\n"):
        (tmp_path / "a.csv").write_text("a,b\nk,l\n" + body)
        with pytest.raises(Exception, match="(?i)not closed|malformed"):
            exports.read(spark, str(tmp_path / "a.csv"), True).select("a").collect()


def test_files_without_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n")
    assert exports.read(spark, str(tmp_path / "a.csv"), True).collect() == []
    (tmp_path / "a.csv").write_text('a,b\n\n\n1,"2"')
    assert cells(exports.read(spark, str(tmp_path / "a.csv"), True)) == [("1", "2")]


def test_lines_stay_in_their_ranges(spark, tmp_path):
    """One exchange for the lines; only records of several lines move again."""
    written(tmp_path / "a.csv", ["a", "b"], [("1", "x\ny")])
    plan = exports.records(spark, str(tmp_path / "a.csv"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert exports.records(spark, str(tmp_path / "a.csv")).filter(~F.col("is_header")).collect()[0].record == '1,"x\ny"'
