"""CSV, workbook, table and JDBC sinks."""

import glob
import io
from datetime import datetime
from pathlib import Path

import pandas as pd
import pytest

from releasemill.model import TARGET_SCHEMA
from releasemill.operators import frame as fr
from releasemill.operators import sinks
from releasemill.sources import sheet

EDGES = [
    ("", None, ' x,"q" ', "l1\nl2"), ("\\", None, "z", None), ("a\rb", "c\r\nd", "#x", "  "),
    ('"', "e\\", "\t", '\\"'), ("", None, "", None), ("a\xa0", "　", ",", "''"),
]


def csv_bytes(path):
    (part,) = glob.glob(f"{path}/*.csv")
    return open(part, "rb").read()


def pandas_csv(rows, columns):
    buffer = io.BytesIO()
    pd.DataFrame(rows, columns=columns).to_csv(buffer, index=False, encoding="utf-8")
    return buffer.getvalue()


@pytest.mark.parametrize("rows", [EDGES, [("",), ("x",), (None,)]], ids=["edges", "one column"])
def test_csv_is_byte_identical_to_pandas(spark, tmp_path, rows):
    columns = list("abcd")[: len(rows[0])]
    frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).coalesce(1)
    path = sinks.write_csv(frame, str(tmp_path / "out"))
    assert csv_bytes(path) == pandas_csv(rows, columns)
    back = [tuple(r) for r in sinks.read_csv(spark, path, frame.schema).collect()]
    assert back == [tuple(v or None for v in row) for row in rows]


def test_excel_parts_respect_the_guard(spark, tmp_path):
    frame = spark.range(1000).selectExpr("cast(id as string) a", "if(id % 2 = 0, null, '<&>') b")
    path = sinks.write_excel(frame.repartition(2), str(tmp_path / "out"), guard=300)
    parts = [list(sheet.records(open(p, "rb").read())) for p in glob.glob(f"{path}/*.xlsx")]
    assert max(map(len, parts)) <= 300
    rows = sorted((int(r["a"]), r.get("b")) for part in parts for r in part)
    assert rows == [(i, None if i % 2 == 0 else "<&>") for i in range(1000)]


@pytest.mark.parametrize(
    "requested, rows, expected", [("excel", 5, "excel"), ("excel", 6, "csv"), ("csv", 9, "csv")]
)
def test_format_route(spark, requested, rows, expected):
    assert sinks.route_format(spark.range(rows), requested, guard=5) == expected


@pytest.mark.parametrize("rows, suffix", [(5, "xlsx"), (6, "csv")])
def test_save_file_routes_and_calls_back(spark, tmp_path, rows, suffix):
    seen = []
    sinks.save_file(
        spark.range(rows), str(tmp_path / "out"), "excel", guard=5,
        on_saved=lambda frame: seen.append(frame.count()),
    )
    assert glob.glob(f"{tmp_path}/out/*.{suffix}") and seen == [rows]


def test_callback_errors_do_not_matter(spark, tmp_path):
    def fail(frame):
        raise RuntimeError("no")

    assert sinks.save_file(spark.range(1), str(tmp_path / "out"), on_saved=fail)


def test_output_name():
    now = datetime(2026, 3, 26, 9, 5, 7)
    assert sinks.output_name("full", "20260301", now, "csv") == "udid_full_20260301_20260326_090507.csv"


def target(spark, keys):
    frame = spark.createDataFrame([(k, "n") for k in keys], "deviceRecordKey string, prdName string")
    return fr.target_projection(
        fr.add_lineage(fr.rename_columns(frame), data_date="20260326", now=datetime(2026, 3, 26), kind="daily")
    )


@pytest.mark.parametrize("storage", ["parquet", "text"])
def test_table_append_by_name(spark, tmp_path, storage):
    table = f"devices_{storage}"
    sinks.create_table(spark, table, str(tmp_path / "t"), storage)
    sinks.write_table(target(spark, ["a", "b"]), table)
    sinks.write_table(target(spark, ["c"]).select(*reversed(TARGET_SCHEMA.names)), table)
    rows = spark.table(table).collect()
    assert sorted(r["device_record_key"] for r in rows) == ["a", "b", "c"]
    assert {r["source_file"] for r in rows} == {"daily_merged"}
    if storage == "text":
        # An empty partition writes an empty part.
        parts = [Path(part).read_text(encoding="utf-8") for part in glob.glob(f"{tmp_path}/t/*.csv")]
        lines = [line for part in parts for line in part.splitlines()]
        assert [line.count("\t") for line in lines] == [23] * 3


class Recorder:
    """Stands in for a writer: keeps the options a write would use."""

    def __init__(self):
        self.kept = {}

    def format(self, name):
        self.kept["format"] = name
        return self

    def options(self, **options):
        self.kept.update(options)
        return self

    def mode(self, mode):
        self.kept["mode"] = mode
        return self

    def save(self):
        self.kept["saved"] = True


def test_jdbc_options():
    class Frame:
        columns = [*TARGET_SCHEMA.names, "create_time"]
        write = Recorder()

    sinks.jdbc_writer(Frame, "jdbc:x:", sinks.TARGET_TABLE, user="u").mode("append").save()
    kept = Frame.write.kept
    assert (kept["format"], kept["mode"], kept["batchsize"]) == ("jdbc", "append", 1000)
    assert (kept["dbtable"], kept["user"], kept["saved"]) == ("udi_device_data", "u", True)
    types = dict(part.split(" ", 1) for part in kept["createTableColumnTypes"].split(", "))
    assert types["prod_desc"] == "VARCHAR(1000)" and types["create_time"] == "TIMESTAMP"
    assert len(types) == 25 and kept["numPartitions"] == sinks.JDBC_CONNECTIONS


def test_fallback(spark, tmp_path):
    frame, path = spark.range(3), str(tmp_path / "out")
    wrote = []

    def fail(staged):
        staged.count()
        raise RuntimeError("refused")

    def to_file(staged):
        wrote.append(staged.count())
        sinks.write_csv(staged, path)

    assert sinks.save_with_fallback(frame, lambda staged: None, to_file) == "database"
    assert wrote == []
    assert sinks.save_with_fallback(frame, fail, to_file) == "file"
    assert sinks.save_with_fallback(frame, None, lambda f: wrote.append(f.count())) == "file"
    assert wrote == [3, 3]


def test_workbooks_of_two_runs_do_not_mix(spark, tmp_path):
    sinks.write_excel(spark.range(3), str(tmp_path / "out"))
    with pytest.raises(FileExistsError):
        sinks.write_excel(spark.range(1), str(tmp_path / "out"))


def test_save_file_tells_the_format(spark, tmp_path):
    written = [sinks.save_file(spark.range(n), str(tmp_path / str(n)), "excel", guard=5) for n in (5, 6)]
    assert written == ["excel", "csv"]


def test_counting_rows_needs_no_single_task_of_rows(spark):
    plan = sinks.format_route(spark.range(100), "excel")._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan


class Writer:
    """Records what a data frame writer is told."""

    def __init__(self, log, fail=None):
        self.log, self.fail = log, fail

    def mode(self, name):
        self.log[-1]["mode"] = name
        return self

    def save(self):
        if self.fail and self.log[-1]["dbtable"] != self.fail:
            raise RuntimeError("database is gone")


@pytest.mark.parametrize("broken", [False, True])
def test_jdbc_appends_through_a_staging_table(spark, monkeypatch, broken):
    writes, statements = [], []

    def writer(frame, url, table, **options):
        writes.append({"dbtable": table, "columns": frame.columns, **options})
        return Writer(writes, fail="t" if broken else None)

    monkeypatch.setattr(sinks, "jdbc_writer", writer)
    frame = spark.range(3).selectExpr("id a", "id b")

    def run(_spark, url, texts, options, transaction):
        statements.append((url, texts, options, transaction))

    if broken:
        with pytest.raises(RuntimeError):
            sinks.write_jdbc(frame, "jdbc:x", "t", execute=run, user="u")
    else:
        sinks.write_jdbc(frame, "jdbc:x", "t", execute=run, user="u")
    staging = writes[1]["dbtable"]
    assert [w["dbtable"] for w in writes] == ["t", staging] and staging.startswith("t_stage_")
    assert [w["mode"] for w in writes] == ["append", "errorifexists"]
    moved = ("jdbc:x", [f"INSERT INTO t (a, b) SELECT a, b FROM {staging}"], {"user": "u"}, True)
    cleared = ("jdbc:x", [f"DROP TABLE {staging}"], {"user": "u"}, False)
    assert statements == ([cleared] if broken else [moved, cleared])


def test_map_columns_become_text(spark, tmp_path):
    frame = spark.sql("SELECT 'x' a, map('k', 'v') other_fields")
    path = sinks.write_csv(frame, str(tmp_path / "out"))
    assert csv_bytes(path).decode().splitlines() == ["a,other_fields", 'x,"{""k"":""v""}"']
    sinks.write_excel(frame, str(tmp_path / "book"))
