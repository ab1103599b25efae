"""Widening, order, target shape."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import device_xml
from releasemill.model import KNOWN_FIELDS, RENAMES, TARGET_SCHEMA
from releasemill.operators import frame as fr
from releasemill.plans import ingest
from releasemill.sources.archives import scan_archives


def merged(spark, folder, columns=KNOWN_FIELDS, **options):
    bronze = ingest.read_bronze(scan_archives(spark, folder), columns=columns)
    return ingest.merged_frame(bronze, **options)


@pytest.mark.parametrize("columns", [(), ("a", "z"), ("a", "b", "c")])
def test_widening_first_seen_order(spark, landing, columns):
    landing("1.zip", [("x.xml", device_xml({"b": 1, "a": 2})), ("w.xml", device_xml({"a": 3, "c": 4}))])
    landing("2.zip", [("a.xml", device_xml({"d": "", "b": 5}))])
    frame = merged(spark, landing.folder, columns)
    assert frame.columns == ["b", "a", "c", "d"]
    rows = {tuple(r) for r in frame.collect()}
    assert rows == {("1", "2", None, None), (None, "3", "4", None), ("5", None, None, "")}


def test_field_named_like_a_lineage_column(spark, landing):
    record = {"archive": "a", "entry": "e", "ord": "o", "fields": "f", "error": "x", "layout": "l"}
    landing("1.zip", [("x.xml", device_xml(record))])
    assert merged(spark, landing.folder).first().asDict() == record


def test_fields_differing_in_case_share_a_map(spark, landing):
    landing("1.zip", [("x.xml", device_xml({"a": 1, "A": 2}, {"b": 3}))])
    frame = merged(spark, landing.folder)
    assert frame.columns == ["a", "b", "other_fields"]
    assert sorted(map(tuple, frame.collect()), key=repr) == [("1", None, {"A": "2"}), (None, "3", {})]


def test_known_fields_differing_in_case(spark, landing):
    landing("1.zip", [("x.xml", device_xml({"PRDNAME": 1, "prdName": 2}))])
    row = merged(spark, landing.folder, ("prdName",)).first()
    assert row.asDict() == {"PRDNAME": "1", "other_fields": {"prdName": "2"}}


def test_surplus_fields_share_a_map(spark, landing, monkeypatch):
    monkeypatch.setattr(fr, "MAX_FIELDS", 2)
    landing("1.zip", [("x.xml", device_xml({"a": 1, "b": 2, "c": 3, "d": 4}, {"d": 5}))])
    frame = merged(spark, landing.folder)
    assert frame.columns == ["a", "b", "other_fields"]
    rows = sorted(map(tuple, frame.collect()), key=repr)
    assert rows == [("1", "2", {"c": "3", "d": "4"}), (None, None, {"d": "5"})]


def test_known_fields_above_the_cap_keep_their_columns(spark, landing, monkeypatch):
    """A late record key is a column, so the frame is sorted; what is not shown is in the map."""
    monkeypatch.setattr(fr, "MAX_FIELDS", 2)
    late = [{"a": 1, "b": 2, "c": 3, "PRDNAME": "up", "prdName": "p", "deviceRecordKey": "K2"}, {"deviceRecordKey": "K1"}]
    landing("1.zip", [("x.xml", device_xml(*late))])
    frame = merged(spark, landing.folder, ("deviceRecordKey", "prdName"))
    assert frame.columns == ["a", "b", "prdName", "deviceRecordKey", "other_fields"]
    assert list(map(tuple, frame.collect())) == [
        (None, None, None, "K1", {}), ("1", "2", "p", "K2", {"c": "3", "PRDNAME": "up"}),
    ]


def test_sort_by_key_missing_last_duplicates_kept(spark, landing):
    key = "deviceRecordKey"
    landing("1.zip", [("x.xml", device_xml({key: "b"}, {"n": "none"}, {key: "a", "n": "first"}))])
    landing("2.zip", [("y.xml", device_xml({key: "a", "n": "second"}, {key: ""}))])
    rows = merged(spark, landing.folder).collect()
    assert [(r[key], r["n"]) for r in rows] == [
        ("", None), ("a", "first"), ("a", "second"), ("b", None), (None, "none"),
    ]


def test_frame_without_key_is_not_sorted(spark, landing):
    landing("1.zip", [("x.xml", device_xml({"x": 1}, {"x": 2}))])
    frame = merged(spark, landing.folder)
    assert "Sort" not in frame._jdf.queryExecution().executedPlan().toString()
    assert frame.count() == 2


def test_a_hot_key_is_split_over_range_partitions(spark):
    rows = spark.range(20_000).select(
        F.lit("same").alias("deviceRecordKey"), F.lit(0).alias("_release_ord"),
        F.lit("a").alias("_archive"), F.lit(0).alias("_entry_ord"), F.col("id").alias("_ord"),
    )
    size = 20 * fr.SORT_TASK_BYTES
    parts = fr.sort_records(rows, size).select(F.spark_partition_id().alias("p"), "_ord")
    counts = [r["count"] for r in parts.groupBy("p").count().collect()]
    assert len(counts) == 20 and max(counts) < 3_000
    assert [r["_ord"] for r in parts.collect()] == list(range(20_000))


def test_position_numbers_every_row_once(spark):
    frame = spark.range(5_000).select(((F.col("id") * 7919) % 5_000).alias("k")).repartition(7)
    rows = fr.with_position(frame, [F.col("k").desc()], "n").collect()
    assert sorted((r["n"], r["k"]) for r in rows) == [(i + 1, 4_999 - i) for i in range(5_000)]


def test_layout_count_is_what_gets_shuffled(spark, landing):
    landing("1.zip", [("x.xml", device_xml({"a": 1}))])
    bronze = ingest.read_bronze(scan_archives(spark, landing.folder))
    grouped = fr.good_records(bronze.rows).groupBy("layout").agg(F.min("ord"))
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    schema = plan.split("ReadSchema: ")[1]
    assert "fields" not in schema and "prdName" not in schema


def test_target_projection(spark):
    now = datetime(2026, 3, 26, 1, 2, 3)
    source = spark.createDataFrame([("k", "n", "e")], "deviceRecordKey string, prdName string, extra string")
    frame = fr.add_lineage(fr.rename_columns(source), data_date="20260326", now=now, kind="daily")
    assert fr.unmapped_columns(frame) == ["extra"]
    target = fr.target_projection(frame)
    assert target.columns == TARGET_SCHEMA.names and len(target.columns) == 24
    row = target.first()
    assert (row["device_record_key"], row["prd_name"], row["org_code"]) == ("k", "n", None)
    assert (row["data_date"], row["data_zip_file"], row["download_time"]) == ("20260326", "", now)
    assert (row["source_file"], row["source_type"]) == ("daily_merged", "daily")
    with pytest.raises(ValueError, match="extra"):
        fr.target_projection(frame, on_unmapped="fail")


def test_all_known_fields_have_a_place():
    assert len(RENAMES) == 19 and set(RENAMES.values()) <= set(TARGET_SCHEMA.names)


def test_nan_becomes_null_and_empty_text_stays(spark):
    frame = spark.createDataFrame([(float("nan"), ""), (1.5, None)], "x double, t string")
    assert [tuple(r) for r in fr.nan_to_null(frame).collect()] == [(None, ""), (1.5, None)]


def test_union_by_name(spark):
    a = spark.createDataFrame([("1", "2")], "b string, a string")
    b = spark.createDataFrame([("3", "4"), ("3", "4")], "a string, c string")
    frame = fr.union_by_name(a, b)
    assert frame.columns == ["b", "a", "c"]
    assert [tuple(r) for r in frame.collect()] == [("1", "2", None), (None, "3", "4"), (None, "3", "4")]
