"""Appends that happen once, and runs that are stopped and repeated."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import device_xml, zip_bytes
from releasemill.operators import catalog as cat
from releasemill.operators.published import LostRows, PublishedTable, create_once, read_text
from releasemill.plans import ingest, runs
from releasemill.sources.archives import scan_archives


def rows_of(table):
    return sorted(r["id"] for r in table.read("rows", "id long").collect())


def test_create_once(spark, tmp_path):
    path = str(tmp_path / "a" / "file")
    assert read_text(spark, path) is None
    assert create_once(spark, path, "first") and not create_once(spark, path, "second")
    assert read_text(spark, path) == "first"
    assert [p.name for p in (tmp_path / "a").iterdir() if not p.name.endswith(".crc")] == ["file"]


def test_a_run_appends_once(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    assert rows_of(table) == [] and table.vacuum() == 0
    assert table.append("one", {"rows": spark.range(3)})
    assert not table.append("one", {"rows": spark.range(3)})
    assert table.append("two", {"rows": spark.range(3, 5), "more": spark.range(1)})
    assert rows_of(table) == [0, 1, 2, 3, 4]
    assert sorted((r["run"], r["name"], r["rows"]) for r in table.parts().collect()) == [
        ("one", "rows", 3), ("two", "more", 1), ("two", "rows", 2),
    ]
    with pytest.raises(ValueError, match="cannot name"):
        table.append("a/b", {"rows": spark.range(1)})


def test_a_failed_append_leaves_nothing(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    table.append("one", {"rows": spark.range(2)})
    broken = spark.range(100).withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("torn"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="torn"):
        table.append("two", {"rows": spark.range(2, 4), "other": broken})
    with pytest.raises(LostRows):
        table.append("two", {"rows": spark.range(2, 4)}, expected={"rows": 3})
    assert rows_of(table) == [0, 1] and not table.has("two")
    assert table.vacuum() >= 2 and rows_of(table) == [0, 1]
    assert table.append("two", {"rows": spark.range(2, 4)}, expected={"rows": 2}) and rows_of(table) == [0, 1, 2, 3]


def test_of_two_writers_of_a_run_one_counts(spark, tmp_path, monkeypatch):
    table = PublishedTable(spark, str(tmp_path / "t"))
    monkeypatch.setattr(table, "has", lambda run: False)  # neither saw the other begin
    assert table.append("one", {"rows": spark.range(3)}) and not table.append("one", {"rows": spark.range(3)})
    assert rows_of(table) == [0, 1, 2]


def test_later_columns_are_added(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    table.append("a", {"rows": spark.range(1)})
    table.append("b", {"rows": spark.range(1, 2).withColumn("x", F.lit("new"))})
    assert sorted((r["id"], r["x"]) for r in table.read("rows", "id long").collect()) == [(0, None), (1, "new")]
    table.append("c", {"rows": spark.range(1).withColumn("x", F.lit(1))})
    with pytest.raises(TypeError, match="several types"):
        table.read("rows", "id long")


# --- runs over releases


def take(spark, folder, path, owner="a", batch=2):
    located = scan_archives(spark, folder)
    return runs.Ledger(spark, path).take(located, owner, batch)


def keys(spark, path):
    return [r["deviceRecordKey"] for r in runs.Ledger(spark, path).frame().collect()]


def record(key, **more):
    return [("a.xml", device_xml({"deviceRecordKey": key, **more}))]


def test_only_new_failed_and_changed_releases_are_taken(spark, landing, tmp_path):
    path = str(tmp_path / "ledger")
    for n in range(4):
        landing(f"{n}.zip", record(f"K{n}"))
    landing("bad.zip", b"no archive")
    assert take(spark, landing.folder, path) == runs.Taken(read=4, failed=1)
    assert take(spark, landing.folder, path) == runs.Taken(failed=1)  # what failed is tried again
    landing("bad.zip", record("K9"))
    landing("1.zip", record("K1b", odd="x"))  # its records replace the old ones
    landing("5.zip", record("K5"))
    assert take(spark, landing.folder, path) == runs.Taken(read=3)
    assert keys(spark, path) == ["K0", "K1b", "K2", "K3", "K5", "K9"]
    assert take(spark, landing.folder, path) == runs.Taken()
    landing("2.zip", b"spoilt")  # the last state that could be read stays
    assert take(spark, landing.folder, path) == runs.Taken(failed=1)
    ledger = runs.Ledger(spark, path)
    assert ledger.frame().columns == ["deviceRecordKey", "odd"]
    assert keys(spark, path) == ["K0", "K1b", "K2", "K3", "K5", "K9"]
    assert sum(r["fatal"] for r in ledger.failures().collect()) == 3


def test_a_stopped_run_repeated_equals_one_run(spark, landing, tmp_path, monkeypatch):
    for n in range(5):
        landing(f"{n}.zip", record(f"K{n}", **{f"f{n}": n}))
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    take(spark, landing.folder, one)
    append, count = PublishedTable.append, []

    def dies(self, run, parts, expected=None):
        count.append(run)
        if len(count) == 3:
            raise KeyboardInterrupt  # parsed and about to be published
        return append(self, run, parts, expected)

    monkeypatch.setattr(PublishedTable, "append", dies)
    with pytest.raises(KeyboardInterrupt):
        take(spark, landing.folder, two)
    assert len(keys(spark, two)) == 4
    monkeypatch.undo()
    assert take(spark, landing.folder, two, owner="other").held > 0  # the claims of the stopped run hold
    take(spark, landing.folder, two)
    frames = [runs.Ledger(spark, path).frame() for path in (one, two)]
    assert sorted(frames[0].columns) == sorted(frames[1].columns)
    columns = sorted(frames[0].columns)
    assert frames[0].select(columns).collect() == frames[1].select(columns).collect()


def doc(name, key, **more):
    return name, device_xml({"deviceRecordKey": key, **more})


def rows(frame):
    return frame.columns, frame.collect()


def broken_then_whole(spark, monkeypatch):
    """Makes documents that hold OLD unreadable until it is called."""
    from releasemill.sources import records as rec

    plain = rec._entry_blocks

    def old(entry, reader, limits):
        if b"OLD" in reader.read(entry):
            raise rec.devicexml.ET.ParseError("a form the parser does not know")
        return plain(entry, reader, limits)

    monkeypatch.setattr(rec, "_entry_blocks", old)
    return lambda: monkeypatch.setattr(rec, "_entry_blocks", plain)


def test_a_replay_reads_only_failed_entries(spark, landing, tmp_path, monkeypatch):
    path, ledger = str(tmp_path / "ledger"), runs.Ledger(spark, str(tmp_path / "ledger"))
    nested = zip_bytes([doc("n1.xml", "OLD3", late="x"), doc("n2.xml", "K4")])
    landing("1.zip", [doc("a.xml", "K1"), doc("b.xml", "OLD2", early="y"), ("in.zip", nested), ("c.xml", "<r><dev")])
    landing("2.zip", [doc("a.xml", "K5")])
    landing("bad.zip", b"no archive")
    mend = broken_then_whole(spark, monkeypatch)
    take(spark, landing.folder, path)
    assert keys(spark, path) == ["K1", "K4", "K5"] and ledger.open_failures().count() == 3
    located = scan_archives(spark, landing.folder)
    assert ledger.replay(located, "a") == runs.Replayed(failed=3)  # the parser is as it was
    assert keys(spark, path) == ["K1", "K4", "K5"] and ledger.open_failures().count() == 3
    mend()
    from releasemill.sources import records as rec

    plain, log = rec._entry_blocks, str(tmp_path / "read")

    def noted(entry, reader, limits):
        with open(log, "a") as out:
            out.write(entry["entry"] + "\n")
        return plain(entry, reader, limits)

    monkeypatch.setattr(rec, "_entry_blocks", noted)
    assert ledger.replay(located, "a") == runs.Replayed(read=2, failed=1)
    assert sorted(open(log).read().split()) == ["b.xml", "c.xml", "n1.xml"]
    assert [r["entry"] for r in ledger.open_failures().collect()] == ["c.xml"]
    assert ledger.replay(located, "a") == runs.Replayed(failed=1)  # each record once
    monkeypatch.undo()
    landing("bad.zip", b"no archive")
    whole = ingest.ingest_release(located, "skip")
    assert rows(ledger.frame()) == rows(whole) and "late" in whole.columns


def test_a_replay_leaves_changed_and_claimed_releases(spark, landing, tmp_path, monkeypatch):
    path, ledger = str(tmp_path / "ledger"), runs.Ledger(spark, str(tmp_path / "ledger"))
    for n in range(3):
        landing(f"{n}.zip", [doc("a.xml", f"K{n}"), doc("b.xml", f"OLD{n}")])
    mend = broken_then_whole(spark, monkeypatch)
    take(spark, landing.folder, path)
    mend()
    landing("0.zip", [doc("a.xml", "K0"), doc("b.xml", "OLD0"), doc("c.xml", "K9")])
    located = scan_archives(spark, landing.folder)
    one = located.where("file_name = '1.zip'").first()
    assert ledger.claim(one, "other", 60)
    assert ledger.replay(located, "a") == runs.Replayed(read=1, held=1)
    assert keys(spark, path) == ["K0", "K1", "K2", "OLD2"]
    take(spark, landing.folder, path)  # the changed release, now readable as a whole
    ledger._release_claims([one])
    assert ledger.replay(located, "a", batch=1) == runs.Replayed(read=1)
    assert keys(spark, path) == ["K0", "K1", "K2", "K9", "OLD0", "OLD1", "OLD2"]
    assert ledger.open_failures().count() == 0 and ledger.replay(located, "a") == runs.Replayed()


def test_a_replay_of_an_archive_gone_bad_keeps_its_failures(spark, landing, tmp_path, monkeypatch):
    path, ledger = str(tmp_path / "ledger"), runs.Ledger(spark, str(tmp_path / "ledger"))
    folder = landing("1.zip", [doc("a.xml", "K1"), doc("b.xml", "OLD1")])
    mend = broken_then_whole(spark, monkeypatch)
    take(spark, folder, path)
    mend()
    located = scan_archives(spark, folder)
    held = spark.createDataFrame(located.collect(), located.schema)  # listed before it went bad
    landing("1.zip", b"spoilt")
    assert ledger.replay(held, "a") == runs.Replayed(failed=1)
    assert keys(spark, path) == ["K1"] and ledger.open_failures().count() == 1


def test_claims_end_with_their_lease(spark, landing, tmp_path):
    ledger = runs.Ledger(spark, str(tmp_path / "ledger"))
    release = {"archive": "a", "length": 1, "modification_time": 0}
    assert ledger.claim(release, "a", 60) and ledger.claim(release, "a", 60)
    assert not ledger.claim(release, "b", 60)
    assert ledger.claim({**release, "length": 2}, "b", 60)  # a changed archive is another release
    other = {**release, "archive": "b"}
    assert ledger.claim(other, "a", -1) and ledger.claim(other, "b", 60) and not ledger.claim(other, "a", 60)


def test_a_batch_is_claimed_by_one_file(spark, landing, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "ledger"), []
    for n in range(5):
        landing(f"{n}.zip", record(f"K{n}"))
    publish = runs.Ledger._publish

    def noted(self, rows):
        seen.append([p.name for p in (tmp_path / "ledger" / "claims").iterdir() if not p.name.endswith(".crc")])
        return publish(self, rows)

    monkeypatch.setattr(runs.Ledger, "_publish", noted)
    assert take(spark, landing.folder, path, batch=5) == runs.Taken(read=5)
    assert [len(names) for names in seen] == [1]


def test_of_claims_made_at_once_one_stands(spark, tmp_path):
    ledger = runs.Ledger(spark, str(tmp_path / "ledger"))
    release = {"archive": "a", "length": 1, "modification_time": 0}
    for n in range(5):
        with ThreadPoolExecutor(4) as pool:
            got = list(pool.map(lambda k: ledger.claim({**release, "length": n}, f"o{k}", 60), range(4)))
        assert sum(got) == 1


def test_claims_that_meet_share_no_release(spark, tmp_path):
    ledger = runs.Ledger(spark, str(tmp_path / "ledger"))
    made = [{"archive": str(n), "length": 1, "modification_time": 0} for n in range(6)]
    name = ledger._claim_name
    assert ledger._claim_all(map(name, made[:4]), "a", 60) == set(map(name, made[:4]))
    assert ledger._claim_all(map(name, made[2:]), "b", 60) == set(map(name, made[4:]))
    assert ledger._claim_all(map(name, made), "a", 60) == set(map(name, made[:4]))  # its own, again
    ledger._release_claims(made, "b")
    ledger._release_claims(made[:2], "a")  # a part of its claims
    assert ledger._claim_all(map(name, made), "b", 60) == set(map(name, made[:2] + made[4:]))
    ledger._release_claims(made)
    assert ledger._held() == {}


def test_claims_of_earlier_versions_hold(spark, tmp_path):
    ledger = runs.Ledger(spark, str(tmp_path / "ledger"))
    release = {"archive": "a", "length": 1, "modification_time": 0}
    for until, free in ((9e9, False), (1, True)):
        file = f"{ledger.table.path}/claims/{ledger._claim_name(release)}"
        assert create_once(spark, file, f'{{"owner": "a", "until": {until}}}')
        assert ledger.claim(release, "b", 60) == free
        ledger._release_claims([release])


def test_growing_layouts_equal_one_batch(spark, landing, tmp_path):
    path, fields = str(tmp_path / "ledger"), []
    for n in range(3):
        landing(f"{n}.zip", [("a.xml", device_xml({"deviceRecordKey": f"K{n}", **{f"f{k}": k for k in range(n + 1)}}))])
        take(spark, landing.folder, path)
        fields.append(runs.Ledger(spark, path).fields())
    assert fields == [["deviceRecordKey", "f0"], ["deviceRecordKey", "f0", "f1"], ["deviceRecordKey", "f0", "f1", "f2"]]
    whole = ingest.ingest_release(scan_archives(spark, landing.folder))
    frame = runs.Ledger(spark, path).frame()
    assert frame.columns == whole.columns and frame.collect() == whole.collect()


def test_small_releases_are_taken_in_few_batches(spark, landing, tmp_path, monkeypatch):
    assert runs.usual_batch(2400, 50 << 20) == 4096 and runs.usual_batch(10, 0) == 4096
    assert runs.usual_batch(100_000, 100_000 << 30) == 64  # a full release each
    assert runs.usual_batch(1000, 100 << 30) == 160
    for n in range(66):  # above the former 64
        landing(f"{n:02d}.zip", [doc("a.xml", f"K{n:02d}"), ("b.xml", "<r>")])
    path, ledger = str(tmp_path / "ledger"), runs.Ledger(spark, str(tmp_path / "ledger"))
    located = scan_archives(spark, landing.folder)
    assert ledger.claim(located.where("file_name = '01.zip'").first(), "other", 60)
    assert ledger.take(located, "a") == runs.Taken(read=65, held=1)
    assert len(keys(spark, path)) == 65 and "K01" not in keys(spark, path)
    assert ledger.releases().select("run").distinct().count() == 1
    assert ledger.replay(located, "a") == runs.Replayed(failed=65)
    assert ledger.table.read("replays", runs.REPLAYS).select("replay").distinct().count() == 1
    claims = [p for p in (tmp_path / "ledger" / "claims").iterdir() if not p.name.endswith(".crc")]
    assert len(claims) == 1


def test_a_run_reads_the_listing_once(spark, landing, tmp_path):
    for n in range(3):
        landing(f"{n}.zip", [doc("a.xml", f"K{n}"), ("b.xml", "<r>")])
    listed, looks = scan_archives(spark, landing.folder), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            looks.add(batch.num_rows)
            yield batch

    archives = listed.mapInArrow(counted, listed.schema)
    items = [("daily", n, f"UDID_DAY_UPDATE_2026010{n + 1}", f"https://feed.example/{n}.zip") for n in range(3)]
    catalog = cat.build_catalog(spark.createDataFrame(items, "kind string, feed_pos long, title string, link string"))
    path = str(tmp_path / "ledger")
    assert runs.ingest_remaining(catalog, archives, path) == runs.Taken(read=3)
    assert looks.value == 3
    assert runs.replay_failures(catalog, archives, path) == runs.Replayed(failed=3)
    assert looks.value == 6 and keys(spark, path) == ["K0", "K1", "K2"]
