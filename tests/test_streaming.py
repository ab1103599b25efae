"""The landing folder as a stream."""

import pytest

from conftest import device_xml, zip_bytes
from releasemill.streaming import landing as ls
from releasemill.streaming import source


def test_each_archive_is_ingested_once(spark, landing, tmp_path):
    target, checkpoint = str(tmp_path / "target"), str(tmp_path / "checkpoint")

    def run():
        ls.ingest_incremental(spark, landing.folder, target, checkpoint)
        rows = spark.read.parquet(target).collect()
        return sorted((r["deviceRecordKey"], r["batch"]) for r in rows)

    landing("1.zip", [("a.xml", device_xml({"deviceRecordKey": "K1", "odd": "x"}))])
    landing("bad.zip", b"broken")
    assert run() == [("K1", 0)]
    assert run() == [("K1", 0)]
    landing("2.zip", [("a.xml", device_xml({"deviceRecordKey": "K2"}))])
    assert run() == [("K1", 0), ("K2", 1)]
    odd = {r["deviceRecordKey"]: r["other_fields"] for r in spark.read.parquet(target).collect()}
    assert odd == {"K1": {"odd": "x"}, "K2": {}}
    failures = spark.read.parquet(f"{target}_failures").collect()
    assert [r["archive"].endswith("bad.zip") for r in failures] == [True]


def test_archives_completed_later_are_taken_up(spark, landing, tmp_path):
    """An empty and a truncated file, whole at the next run, lose and repeat nothing."""
    target, checkpoint = str(tmp_path / "target"), str(tmp_path / "checkpoint")

    def run():
        ls.ingest_incremental(spark, landing.folder, target, checkpoint)
        return sorted(r["deviceRecordKey"] for r in spark.read.parquet(target).collect())

    whole = zip_bytes([("a.xml", device_xml({"deviceRecordKey": "K2"}))])
    landing("1.zip", [("a.xml", device_xml({"deviceRecordKey": "K1"}))])
    landing("2.zip", whole[:-30])
    landing("3.zip", b"")
    assert run() == ["K1"]
    assert run() == ["K1"]
    landing("2.zip", whole)
    landing("3.zip", [("a.xml", device_xml({"deviceRecordKey": "K3"}))])
    landing("4.zip", [("a.xml", device_xml({"deviceRecordKey": "K4"}))])
    assert run() == ["K1", "K2", "K3", "K4"]
    assert run() == ["K1", "K2", "K3", "K4"]
    landing("5.zip", b"PK")
    assert run() == ["K1", "K2", "K3", "K4"]
    landing("5.zip", [("a.xml", device_xml({"deviceRecordKey": "K5"}))])
    assert run() == ["K1", "K2", "K3", "K4", "K5"]


def test_a_replayed_batch_replaces_itself(spark, landing, tmp_path):
    landing("1.zip", [("a.xml", device_xml({"deviceRecordKey": "K1"}))])
    from releasemill.sources.archives import scan_archives

    write = ls.append_records(str(tmp_path / "target"))
    for _ in range(2):
        write(scan_archives(spark, landing.folder), 7)
    assert spark.read.parquet(str(tmp_path / "target")).count() == 1


def rows_of(spark, stream, checkpoint):
    """Names and lengths that a run of the stream brings."""
    found = []

    def note(batch, batch_id):
        found.extend((r["file_name"], r["length"]) for r in batch.collect())

    ls.run_available(stream, note, checkpoint)
    return sorted(found)


def test_the_source_tells_versions(spark, landing, tmp_path):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")

    def run(checkpoint=checkpoint):
        return rows_of(spark, ls.landing_stream(spark, landing.folder, log), checkpoint)

    landing("1.zip", b"abc")
    landing("2.zip", b"")
    landing("notes.txt", b"no")
    landing("_hidden.zip", b"no")
    assert run() == [("1.zip", 3)]
    assert run() == []
    landing("2.zip", b"now")
    landing("1.zip", b"longer")
    assert run() == [("1.zip", 6), ("2.zip", 3)]
    # Another checkpoint takes up the whole log in one batch: a file comes once, as it is last.
    assert run(str(tmp_path / "other")) == [("1.zip", 6), ("2.zip", 3)]


def test_listing_equals_the_batch_scan(spark, landing, tmp_path):
    from releasemill.sources.archives import scan_archives

    landing("1 a%20b.zip", b"abc")
    landing("2.zip", b"abcd")
    seen = str(tmp_path / "seen")
    stream = ls.landing_stream(spark, landing.folder, str(tmp_path / "log"))
    ls.run_available(stream, lambda b, _: b.write.parquet(seen), str(tmp_path / "checkpoint"))
    columns = ["archive", "file_name", "length", "release_ord"]
    found = [tuple(r) for r in spark.read.parquet(seen).select(*columns).collect()]
    wanted = [tuple(r) for r in scan_archives(spark, landing.folder).select(*columns).collect()]
    assert sorted(found) == sorted(wanted)


def test_a_batch_that_failed_comes_again_as_it_was(spark, landing, tmp_path):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")

    def fail(batch, batch_id):
        raise RuntimeError("lost")

    landing("1.zip", b"abc")
    with pytest.raises(Exception, match="lost"):
        ls.run_available(ls.landing_stream(spark, landing.folder, log), fail, checkpoint)
    landing("1.zip", b"changed")
    landing("2.zip", b"x")
    batches = {}

    def note(batch, batch_id):
        batches[batch_id] = sorted((r["file_name"], r["length"]) for r in batch.collect())

    for _ in range(2):
        ls.run_available(ls.landing_stream(spark, landing.folder, log), note, checkpoint)
    assert batches == {0: [("1.zip", 3)], 1: [("1.zip", 7), ("2.zip", 1)]}


def test_a_log_is_read_from_its_newest_summary(tmp_path, monkeypatch):
    folder, read = str(tmp_path / "log"), []
    whole = source.Log(folder)
    for k in range(1, 2 * source.SUMMARY_ENTRIES + 3):
        assert whole.note({"a": (k, 0), f"b{k}": (1, 1)}) == k
        assert whole.note({"a": (k, 0)}) == k
    plain = source._read
    monkeypatch.setattr(source, "_read", lambda path: read.append(path) or plain(path))
    again = source.Log(folder)
    assert (again.known, again.last) == (whole.known, whole.last)
    assert len(read) == 3


def test_new_fields_become_columns(spark, landing, tmp_path):
    """Three batches with growing layouts equal one batch ingest; a repeated batch changes nothing."""
    from releasemill.plans import ingest
    from releasemill.sources.archives import scan_archives

    target, checkpoint = str(tmp_path / "target"), str(tmp_path / "checkpoint")
    more = [{}, {"f.0": "a", "Batch": "b"}, {"f1": "", "F.0": "c", "f.0": "d"}]
    for n, fields in enumerate(more):
        landing(f"{n}.zip", [("a.xml", device_xml({"deviceRecordKey": f"K{n}", **fields}))])
        ls.ingest_incremental(spark, landing.folder, target, checkpoint, ("deviceRecordKey",), n > 0)
    frame = ls.read_records(spark, target, ("deviceRecordKey",))
    assert frame.columns == ["deviceRecordKey", "f.0", "f1", "other_fields", "batch"]
    rows = sorted(map(tuple, frame.collect()))
    assert rows == [
        ("K0", None, None, {}, 0), ("K1", "a", None, {"Batch": "b"}, 1), ("K2", "d", "", {"F.0": "c"}, 2),
    ]
    again = scan_archives(spark, landing.folder).where("file_name = '2.zip'")
    ls.append_records(target, ("deviceRecordKey",), True)(again, 2)
    assert sorted(map(tuple, ls.read_records(spark, target, ("deviceRecordKey",)).collect())) == rows
    whole = ingest.ingest_release(scan_archives(spark, landing.folder))
    assert sorted(r["deviceRecordKey"] for r in whole.collect()) == [r[0] for r in rows]


def test_fields_of_the_map_become_columns_later(spark, landing, tmp_path):
    from releasemill.sources.archives import scan_archives

    target, known = str(tmp_path / "target"), ("deviceRecordKey",)
    landing("1.zip", [("a.xml", device_xml({"deviceRecordKey": "K1", "odd": "x"}))])
    landing("2.zip", [("a.xml", device_xml({"deviceRecordKey": "K2", "odd": "y"}))])
    found = scan_archives(spark, landing.folder)
    ls.append_records(target, known)(found.where("file_name = '1.zip'"), 0)
    assert ls.read_records(spark, target, known).columns == ["deviceRecordKey", "other_fields", "batch"]
    ls.append_records(target, known, True)(found.where("file_name = '2.zip'"), 1)
    rows = sorted(map(tuple, ls.read_records(spark, target, known).collect()))
    assert rows == [("K1", "x", {}, 0), ("K2", "y", {}, 1)]
    assert ls.read_records(spark, str(tmp_path / "none"), known).count() == 0
