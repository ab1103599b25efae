"""Listing, slicing and reading of ZIP archives."""

import io
import zipfile

import pytest

from conftest import device_xml, zip_bytes
from releasemill.plans import ingest
from releasemill.sources import archives as arc
from releasemill.sources import records as rec
from releasemill.sources import zipentries as ze


def read_all(data):
    reader = ze.ArchiveReader(io.BytesIO(data))
    return {e["entry"]: reader.read(e) for e in ze.list_directory(io.BytesIO(data))}


@pytest.mark.parametrize(
    "method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA]
)
def test_entries_read_by_offset(method):
    entries = [("a.xml", b"a" * 100_000), ("dir/b.xml", b""), ("c.txt", bytes(range(256)) * 9)]
    assert read_all(zip_bytes(entries, method)) == dict(entries)


def test_highly_compressed_entry_comes_in_bounded_chunks():
    data = zip_bytes([("a.xml", bytes(50 << 20))])
    (entry,) = ze.list_directory(io.BytesIO(data))
    sizes = [len(c) for c in ze.ArchiveReader(io.BytesIO(data)).chunks(entry)]
    assert sum(sizes) == 50 << 20
    assert max(sizes) <= 4 * ze.CHUNK


def test_wrong_checksum_is_an_archive_error():
    data = bytearray(zip_bytes([("a.xml", b"hello hello")], zipfile.ZIP_STORED))
    at = data.index(b"hello")
    data[at] = ord("j")
    (entry,) = ze.list_directory(io.BytesIO(bytes(data)))
    with pytest.raises(zipfile.BadZipFile):
        ze.ArchiveReader(io.BytesIO(bytes(data))).read(entry)


def test_suffixes_are_case_sensitive():
    kinds = [ze.entry_kind(n) for n in ("a.xml", "b.XML", "c.zip", "d.xls", "e.xlsx", "f.txt", "zip")]
    assert kinds == ["xml", None, "zip", "excel", "excel", None, None]


def scan(spark, folder):
    return arc.scan_archives(spark, folder)


def test_scan_reads_no_content(spark, landing):
    landing("a.zip", [("a.xml", device_xml({"k": 1}))])
    plan = scan(spark, landing.folder).select("archive", "release_ord")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in text


def test_partitioned_landing_folder(spark, tmp_path):
    for day in ("20260101", "20260102"):
        folder = tmp_path / "kind=daily" / f"date={day}"
        folder.mkdir(parents=True)
        (folder / "a.zip").write_bytes(zip_bytes([("a.xml", device_xml({"k": day}))]))
    archives = arc.scan_archives(spark, str(tmp_path), partitioned=True)
    chosen = archives.filter("kind = 'daily' AND date = 20260102")
    assert "PartitionFilters: [isnotnull" in chosen._jdf.queryExecution().executedPlan().toString()
    assert [r["fields"]["k"] for r in ingest.read_bronze(chosen).rows.collect()] == ["20260102"]
    assert ingest.read_bronze(scan(spark, str(tmp_path))).records.count() == 2


def weekly(method):
    days = [
        (f"day{d}.zip", zip_bytes([(f"{d}-{i}.xml", device_xml({"k": f"{d}{i}"})) for i in range(3)]))
        for d in range(7)
    ]
    return zip_bytes([*days, ("top.xml", device_xml({"k": "top"}))], method)


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
@pytest.mark.parametrize("threshold", [0, 1 << 30])
def test_nested_archives_whole_or_split(spark, landing, monkeypatch, method, threshold):
    """Large nested archives are cut into slices; the records stay the same."""
    monkeypatch.setattr(arc, "NESTED_SPLIT_BYTES", threshold)
    monkeypatch.setattr(arc, "MIN_SLICE_BYTES", 100)
    monkeypatch.setattr(arc, "MAX_SLICE_BYTES", 100)
    landing("week.zip", weekly(method))
    bronze = ingest.read_bronze(scan(spark, landing.folder))
    rows = bronze.rows.select("parent", "entry", "fields").collect()
    found = sorted((r["parent"] or "", r["entry"], r["fields"]["k"]) for r in rows)
    expected = [(f"day{d}.zip", f"{d}-{i}.xml", f"{d}{i}") for d in range(7) for i in range(3)]
    assert found == sorted([*expected, ("", "top.xml", "top")])
    order = bronze.rows.orderBy("entry_ord", "ord").select("fields").collect()
    assert [r["fields"]["k"] for r in order] == [f"{d}{i}" for d in range(7) for i in range(3)] + ["top"]


def test_only_one_level_of_nesting(spark, landing):
    deep = zip_bytes([("deep.xml", device_xml({"k": "deep"}))])
    middle = zip_bytes([("deep.zip", deep), ("middle.xml", device_xml({"k": "middle"}))])
    landing("a.zip", [("middle.zip", middle)])
    rows = ingest.read_bronze(scan(spark, landing.folder)).rows.collect()
    assert [r["fields"]["k"] for r in rows] == ["middle"]


def test_slices_are_bounded(spark, landing, monkeypatch):
    monkeypatch.setattr(arc, "MIN_SLICE_BYTES", 100)
    monkeypatch.setattr(arc, "MAX_SLICE_BYTES", 100)
    monkeypatch.setattr(arc, "SLICE_ENTRIES", 3)
    bodies = [(f"{i}.xml", "x" * n) for i, n in enumerate([60, 60, 10, 10, 10, 10, 500, 1])]
    landing("a.zip", bodies)
    slices = arc.list_slices(scan(spark, landing.folder)).frame.orderBy("slice_no").collect()
    groups = [[e["size"] for e in s["entries"]] for s in slices]
    assert groups == [[60], [60, 10, 10], [10, 10], [500], [1]]


def test_work_is_dealt_evenly(spark, landing, monkeypatch):
    monkeypatch.setattr(arc, "MAX_SLICE_BYTES", 1)
    monkeypatch.setattr(arc, "MIN_SLICE_BYTES", 1)
    landing("a.zip", [(f"{i}.xml", device_xml({"k": i})) for i in range(16)])
    work = arc.work_items(arc.list_slices(scan(spark, landing.folder)))
    sizes = work.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sizes == [1] * 16


@pytest.mark.parametrize("held", [0, 1 << 30])
def test_large_documents_are_held_or_streamed(spark, landing, monkeypatch, held):
    monkeypatch.setattr(arc, "DOCUMENT_BYTES", 10)
    monkeypatch.setattr(arc, "HELD_DOCUMENT_BYTES", held)
    monkeypatch.setattr(arc, "SEGMENT_CHARS", 100)
    monkeypatch.setattr(rec, "BATCH_ROWS", 7)
    documents = [(f"{i}.xml", device_xml(*({"k": f"{i}-{j}"} for j in range(50)))) for i in range(4)]
    documents[2] = ("2.xml", documents[2][1].replace("<k>2-9<", "<k><!-- </device> -->2-9<"))
    landing("a.zip", [*documents, ("broken.xml", documents[0][1][:-5])])
    bronze = ingest.read_bronze(scan(spark, landing.folder))
    keys = [r["fields"]["k"] for r in bronze.records.orderBy("entry_ord", "ord").collect()]
    assert keys == [f"{i}-{j}" for i in range(4) for j in range(50)]
    places = bronze.records.filter("entry = '1.xml'").orderBy("ord").select("ord").collect()
    assert [r["ord"] for r in places] == list(range(50))
    (failure,) = bronze.dead_letter.collect()
    assert failure["entry"] == "broken.xml" and not failure["fatal"]


def test_manifest_lists_ignored_entries_too(spark, landing):
    landing("a.zip", [("a.xml", "<r/>"), ("readme.txt", "12345"), ("UP.XML", "1")])
    rows = arc.entry_manifest(arc.list_slices(scan(spark, landing.folder))).collect()
    assert [(r["entry"], r["kind"], r["size"]) for r in rows] == [
        ("a.xml", "xml", 4), ("readme.txt", None, 5), ("UP.XML", None, 1),
    ]


def test_empty_archive_gives_nothing(spark, landing):
    landing("a.zip", [])
    bronze = ingest.read_bronze(scan(spark, landing.folder))
    assert bronze.rows.count() == 0


def test_large_documents_are_parsed_by_many_tasks(spark, landing, monkeypatch):
    """Documents that cannot be split, broken ones and torn archives included."""
    monkeypatch.setattr(arc, "MAX_SLICE_BYTES", 200)
    monkeypatch.setattr(arc, "SPLIT_DOCUMENT_BYTES", 300)
    monkeypatch.setattr(arc, "DOCUMENT_BYTES", 300)
    monkeypatch.setattr(arc, "SEGMENT_CHARS", 400)

    def document(name, **extra):
        return device_xml(*({"k": f"{name}{i:03d}", **extra} for i in range(100)))

    landing("a.zip", [
        ("1.xml", document("a")), ("small.xml", device_xml({"k": "s"})),
        ("2.xml", document("b", c="<!-- </device> -->")),
        ("3.xml", document("c")[:-3]),
    ])
    torn = bytearray(zip_bytes([("4.xml", document("d"))], zipfile.ZIP_STORED))
    torn[torn.index(b"d050")] = ord("e")
    landing("torn.zip", bytes(torn))

    bronze = ingest.read_bronze(scan(spark, landing.folder), "skip", columns=("k",))
    keys = [r["k"] for r in bronze.records.orderBy("entry_ord", "ord").collect()]
    expected = [f"a{i:03d}" for i in range(100)] + ["s"] + [f"b{i:03d}" for i in range(100)]
    assert keys == expected
    failures = sorted((r["entry"], r["fatal"]) for r in bronze.dead_letter.collect())
    assert failures == [("3.xml", False), ("4.xml", True)]


def test_records_are_numbered_alike_whatever_the_size(spark, landing):
    """Small limits send documents and nested archives down the paths for large ones."""
    body = device_xml(*({"k": f"{i:04d}"} for i in range(500)))
    inner = zip_bytes([("in.xml", body)])
    landing("a.zip", [("1.xml", body), ("2.xml", device_xml({"k": "x"})), ("n.zip", inner)])
    small = arc.Limits(nested_bytes=100, split_document_bytes=1000, document_bytes=500,
                       held_document_bytes=600, segment_chars=700)
    held = arc.Limits(100, 1 << 20, 500, 1 << 20, 700)

    def rows(limits):
        bronze = ingest.read_bronze(scan(spark, landing.folder), columns=("k",), limits=limits)
        return sorted(tuple(r) for r in bronze.records.select("entry", "parent", "entry_ord", "ord", "k")
                      .fillna("").collect())

    usual = rows(None)
    assert len(usual) == 1001 and max(r[3] for r in usual) == 499
    assert rows(small) == usual and rows(held) == usual


def test_a_deflated_nested_archive_is_inflated_once(landing, tmp_path, monkeypatch):
    body = bytes(range(256)) * 4000
    inner = zip_bytes([(f"{i}.xml", body) for i in range(6)], zipfile.ZIP_STORED)
    landing("a.zip", [("n.zip", inner)])
    (row,) = arc._archive_slices(f"{landing.folder}/a.zip", 0, 1 << 20, 1 << 30)
    read = []
    inflating = zipfile.ZipExtFile.read

    def counted(self, n=-1):
        data = inflating(self, n)
        read.append(len(data))
        return data

    monkeypatch.setattr(zipfile.ZipExtFile, "read", counted)
    slices = list(arc._nested_slices(row, 1 << 20, str(tmp_path / "nested"), 1000, 1 << 30))
    parts = [part for part in slices if part["entries"]]
    assert len(parts) > 1 and sum(read) <= 2 * len(inner)
    found = [reader.read(entry) for part in parts for entry, reader, _ in arc.open_slice(part)]
    assert found == [body] * 6 and sum(read) <= 2 * len(inner)


def test_storage_errors_are_no_bad_archives(spark):
    missing = spark.createDataFrame([("nosuch://bucket/a.zip", 0, 10)],
                                    "archive string, release_ord long, length long")
    with pytest.raises(Exception, match="nosuch|Unrecognized"):
        ingest.read_bronze(missing, "skip")
    gone = spark.createDataFrame([("/nowhere/a.zip", 0, 10)], missing.schema)
    with pytest.raises(Exception, match="nowhere"):
        ingest.read_bronze(gone, "skip")


@pytest.mark.parametrize("error", [TypeError, KeyError, ValueError, IndexError, RuntimeError, OSError])
def test_programming_errors_fail_the_run(spark, landing, monkeypatch, error):
    def wrong(data):
        raise error("not a document's fault")

    monkeypatch.setattr(rec.devicexml, "records", wrong)
    landing("a.zip", [("a.xml", device_xml({"k": 1}))])
    with pytest.raises(Exception, match="not a document's fault"):
        ingest.read_bronze(scan(spark, landing.folder), "skip")


@pytest.mark.parametrize("error", [KeyError, ValueError, IndexError])
def test_errors_of_the_sheet_reader_fail_the_run(spark, landing, monkeypatch, error):
    """A broken workbook is a dead letter, a mistake in its reader is not."""
    landing("a.zip", [("a.xlsx", zip_bytes([("xl/workbook.xml", "<workbook/>")])), ("b.xlsx", b"PK torn")])
    letters = ingest.read_bronze(scan(spark, landing.folder), "skip").dead_letter.collect()
    assert sorted((r["entry"], r["fatal"]) for r in letters) == [("a.xlsx", False), ("b.xlsx", False)]

    def wrong(self, name):
        raise error("not a workbook's fault")

    monkeypatch.setattr(rec.sheet.Workbook, "_tree", wrong)
    with pytest.raises(Exception, match="not a workbook's fault"):
        ingest.read_bronze(scan(spark, landing.folder), "skip")


def test_a_refusal_of_storage_is_no_format_error():
    assert not arc.is_format_error(OSError(22, "invalid argument"))
    assert not arc.is_format_error(KeyError("k")) and not arc.is_format_error(ValueError("v"))
    assert arc.is_format_error(arc.ze.ImpossibleSeek(22, "before the start"))


def test_payloads_and_native_scan_keep_failures(spark, landing):
    landing("a.zip", [("good.xml", device_xml({"k": 1}, {"k": 2})), ("bad.xml", "<r><devices>"),
                      ("torn.zip", b"PK torn")])
    landing("b.zip", b"no archive")
    payloads = arc.entry_payloads(arc.list_slices(scan(spark, landing.folder)))
    found = {(r["archive"][-5:], r["entry"]): r["error"] is not None for r in payloads.collect()}
    assert found == {("a.zip", "good.xml"): False, ("a.zip", "bad.xml"): False,
                     ("a.zip", "torn.zip"): True, ("b.zip", None): True}
    native = rec.parse_payloads_native(payloads).collect()
    good = [(r["ord"], r["fields"]) for r in native if r["error"] is None]
    assert sorted(good, key=repr) == [(0, {"k": "1"}), (1, {"k": "2"})]
    failed = sorted((r["archive"][-5:], r["entry"] or "") for r in native if r["error"])
    usual = ingest.read_bronze(scan(spark, landing.folder), "skip").dead_letter.collect()
    assert failed == sorted((r["archive"][-5:], r["entry"] or "") for r in usual)


def test_large_items_take_tasks_by_their_bytes(spark):
    cores, mib = spark.sparkContext.defaultParallelism, 1 << 20
    slices = arc.Slices(spark.range(1), arc.usual_limits(), 0, 0, 0, 0, 0)
    assert arc.large_tasks(slices, 48_000, 300 * mib) == 4 * cores  # many that are not large: not one task each
    assert arc.large_tasks(slices, 3, 300 * mib) == 3
    assert arc.large_tasks(slices, 1000, 1000 * 65 * mib) == 1000
    assert arc.large_tasks(slices, 0, 0) == 1
