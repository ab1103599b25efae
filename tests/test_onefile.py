"""One CSV file under one header."""

import glob
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from releasemill.operators import onefile, sinks

ODD = ["plain", "a,b", 'say "x"', "two\nlines", " blank ", "器械", "", None, "#x", "\\"]
JOINS = [None, onefile._join_stream]


def odd_rows(count):
    return [(f"{k:04d}", ODD[k % len(ODD)], ODD[(k // 3) % len(ODD)]) for k in range(count)]


def written(path):
    with open(path, "rb") as file:
        return file.read()


def expected(rows, columns, tmp_path):
    path = str(tmp_path / "expected.csv")
    pd.DataFrame(rows, columns=columns).to_csv(path, index=False, encoding="utf-8")
    return written(path)


@pytest.mark.parametrize("join", JOINS, ids=["by place", "streamed"])
def test_bytes_are_those_of_the_rule_over_many_parts(spark, tmp_path, join):
    rows, columns = odd_rows(500), ["id", 'a "name", quoted', "器械"]
    frame = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
    frame = frame.repartitionByRange(7, "id").sortWithinPartitions("id")
    path = onefile.write_csv_file(frame, str(tmp_path / "out.csv"), join, piece_bytes=100)
    assert written(path) == expected(rows, columns, tmp_path)
    assert sorted(os.listdir(tmp_path)) == ["expected.csv", "out.csv"]


@pytest.mark.parametrize("join", JOINS, ids=["by place", "streamed"])
def test_no_rows_one_column_and_empty_partitions(spark, tmp_path, join):
    none = onefile.write_csv_file(spark.createDataFrame([], "a string, b long"), str(tmp_path / "none.csv"), join)
    assert written(none) == b"a,b\n"
    one = spark.createDataFrame([("",), ("x",), (None,)], "a string").coalesce(1)
    path = onefile.write_csv_file(one, str(tmp_path / "one.csv"), join)
    assert written(path) == expected([("",), ("x",), (None,)], ["a"], tmp_path)
    sparse = spark.range(1000, numPartitions=50).where("id % 400 = 7")
    path = onefile.write_csv_file(sparse, str(tmp_path / "sparse.csv"), join)
    assert written(path) == b"id\n7\n407\n807\n"


def test_maps_become_text_and_the_file_reads_back(spark, tmp_path):
    frame = spark.range(3).select("id", F.create_map(F.lit("k"), F.col("id").cast("string")).alias("m"))
    path = onefile.write_csv_file(frame, str(tmp_path / "maps.csv"))
    found = sinks.read_csv(spark, path, "id long, m string").collect()
    assert sorted(tuple(r) for r in found) == [(k, f'{{"k":"{k}"}}') for k in range(3)]


def test_a_file_that_is_there_stays_and_a_failure_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    onefile.write_csv_file(spark.range(3), path)
    before = written(path)
    with pytest.raises(FileExistsError):
        onefile.write_csv_file(spark.range(9), path)
    assert written(path) == before

    def fail(*_):
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        onefile.write_csv_file(spark.range(3), str(tmp_path / "other.csv"), fail)
    assert not glob.glob(f"{tmp_path}/*other*") and not glob.glob(f"{tmp_path}/_*")


def test_pieces_cover_the_parts_in_order():
    own = onefile.pieces([("a", 250), ("b", 100), ("c", 1)], place=9, limit=100)
    assert own == [
        ("a", 0, 100, 9), ("a", 100, 100, 109), ("a", 200, 50, 209), ("b", 0, 100, 259), ("c", 0, 1, 359)
    ]


def test_parts_are_ordered_by_number(spark, tmp_path):
    for name in ("part-100000-x-c000.csv", "part-99999-x-c001.csv", "part-99999-x-c000.csv", "_SUCCESS"):
        (tmp_path / name).write_text("x")
    (tmp_path / "part-00001-x-c000.csv").write_text("")
    found = [path.rpartition("/")[2] for path, _ in onefile._parts(spark, str(tmp_path))]
    assert found == ["part-99999-x-c000.csv", "part-99999-x-c001.csv", "part-100000-x-c000.csv"]


def test_saving_by_rule_gives_one_file_where_asked(spark, tmp_path):
    assert sinks.save_file(spark.range(2), str(tmp_path / "out.csv"), one_file=True) == "csv"
    assert written(tmp_path / "out.csv") == b"id\n0\n1\n"
