"""Feed captures that are cut, damaged, empty or no feeds at all."""

import os

import pytest

from pyspark.sql import functions as F

from releasemill.sources import feed, feedxml

ITEM = "<item><title>T{n}</title><link>https://f/{n}.zip</link></item>"


def rss(*numbers):
    return "<rss><channel><title>all</title>" + "".join(ITEM.format(n=n) for n in numbers) + "</channel></rss>"


def read(text):
    verdict, lost, items = feedxml.read_bytes(text.encode() if isinstance(text, str) else text)
    return verdict, lost, [(i["title"], i["link"]) for i in items]


def pairs(*numbers):
    return [(f"T{n}", f"https://f/{n}.zip") for n in numbers]


WHOLE = rss(1, 2, 3)


@pytest.mark.parametrize("text, expected", [
    (WHOLE, ("whole", 0, pairs(1, 2, 3))),
    (WHOLE[:-10], ("partial", 0, pairs(1, 2, 3))),
    (WHOLE[: WHOLE.index("T3")], ("partial", 1, pairs(1, 2))),
    (WHOLE.replace("</item>", "", 1), ("partial", 1, pairs(2, 3))),  # goes on at the next item
    (WHOLE.replace("</link></item>", "</item>", 1), ("whole", 0, pairs(1, 2, 3))),
    (WHOLE.replace("</title>", "</titel>"), ("whole", 0, [("T1https://f/1.zip", ""), ("T2https://f/2.zip", ""), ("T3https://f/3.zip", "")])),
    (rss(), ("whole", 0, [])),
    ("", ("empty", 0, [])), (" \r\n\0", ("empty", 0, [])), (b"\xef\xbb\xbf", ("empty", 0, [])),
    ("<!DOCTYPE html><html><body><item>no</item></body></html>", ("foreign", 0, [])),
    ("502 Bad Gateway", ("foreign", 0, [])), ('{"item": 1}', ("foreign", 0, [])), ("<rss", ("foreign", 0, [])),
    ("<rss><channel>", ("partial", 0, [])), (None, ("empty", 0, [])),
])
def test_what_can_be_read(text, expected):
    assert read(text or b"") == expected


def test_sections_entities_and_namespaces():
    text = (
        '<?xml version="1.0"?><!-- <item> --><rdf:RDF xmlns:a="x"><item rdf:about="1"><title><![CDATA[a <item> & b]]></title>'
        "<a:link>https://f/?a=1&amp;b=2&c</a:link><description>x <b>y</title> z</description></item>"
        "<item><title>&#22120; <i>in</i> side</title><media><title>not this</title></media><link/></item></rdf:RDF>"
    )
    assert read(text) == ("whole", 0, [("a <item> & b", "https://f/?a=1&b=2&c"), ("器 in side", "")])
    atom = (
        '<feed><entry><title>T</title><link rel="self" href="no"/><link href="https://f/1.zip"/></entry>'
        "<entry><title>器</title></entry></feed>"
    )
    assert read(atom.encode("gbk")) == ("whole", 0, [("T", "https://f/1.zip"), ("器", "")])


def test_hostile_text_takes_linear_time():
    assert read("<rss>" + "<" * 200_000)[0] == "partial"
    assert read("<rss><item " + "a " * 100_000)[0] == "partial"
    assert read("<rss><channel>" + "<item><title>x" * 30_000)[1] == 30_000
    assert read("<rss>" + "<!--" * 50_000)[0] == "partial"


def capture(folder, name, text, time):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    os.utime(path, (time, time))


def test_falls_back_to_the_last_readable_capture(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed, "LATER_ROUNDS", 2)
    capture(tmp_path, "a.xml", rss(9), 1_700_000_000)
    capture(tmp_path, "b.xml", rss(1, 2), 1_700_000_100)
    broken = [WHOLE[: WHOLE.index("T1")], "", "<html></html>", "502"]
    for n, text in enumerate(broken):
        capture(tmp_path, f"c{n}.xml", text, 1_700_000_200 + n)
    rows = feed.scan_feed(spark, str(tmp_path), "daily").collect()
    assert sorted((r["feed_pos"], r["title"]) for r in rows) == [(0, "T1"), (1, "T2")]
    chosen, skipped = feed.latest_readable(feed.captures(spark, str(tmp_path)))
    assert [r["path"][-5:] for r in chosen.collect()] == ["b.xml"]
    assert sorted((r["path"][-6:], r["verdict"], r["lost"]) for r in skipped.collect()) == [
        ("c0.xml", "partial", 1), ("c1.xml", "empty", 0), ("c2.xml", "foreign", 0), ("c3.xml", "foreign", 0),
    ]
    capture(tmp_path, "d.xml", WHOLE[:-30], 1_700_000_300)
    rows = feed.scan_feed(spark, str(tmp_path), "daily").collect()
    assert sorted((r["feed_pos"], r["title"]) for r in rows) == [(0, "T1"), (1, "T2")]


def test_nothing_readable_fails(spark, tmp_path):
    capture(tmp_path, "a.xml", "", 1_700_000_000)
    capture(tmp_path, "b.xml", "<html/>", 1_700_000_001)
    with pytest.raises(feed.UnreadableFeed, match="b.xml"):
        feed.scan_feed(spark, str(tmp_path), "daily")


def test_many_feeds_at_once(spark, tmp_path):
    from pyspark.sql import functions as F

    capture(tmp_path, "daily/1.xml", rss(1), 1_700_000_000)
    capture(tmp_path, "daily/2.xml", "", 1_700_000_001)
    capture(tmp_path, "weekly/1.xml", rss(2, 3), 1_700_000_000)
    capture(tmp_path, "full/1.xml", "<html>", 1_700_000_000)
    found = feed.captures(spark, str(tmp_path), F.element_at(F.split("path", "/"), -2))
    items, skipped = feed.scan_feeds(found)
    assert sorted((r["feed"], r["feed_pos"], r["title"]) for r in items.collect()) == [
        ("daily", 0, "T1"), ("weekly", 0, "T2"), ("weekly", 1, "T3"),
    ]
    assert sorted((r["feed"], r["verdict"]) for r in skipped.collect()) == [("daily", "empty"), ("full", "foreign")]


def test_captures_are_listed_and_read_by_many_tasks(spark, tmp_path):
    body = "<rss><channel><item><title>{}</title></item></channel></rss>"
    for n in range(40):
        folder = tmp_path / f"f{n}" / "_deep"
        folder.mkdir(parents=True)
        (folder / "1.xml").write_text(body.format(n))
        (folder / "_hidden.xml").write_text(body.format("no"))
    (tmp_path / "top.xml").write_text("")
    found = feed.captures(spark, str(tmp_path), F.col("path"))
    paths = sorted(r["path"].removeprefix(f"file:{tmp_path}/") for r in found.collect())
    assert paths == sorted([*(f"f{n}/_deep/1.xml" for n in range(40)), "top.xml"])
    assert found.select(F.spark_partition_id()).distinct().count() > 4
    read = feed.judged(found.coalesce(1))
    assert sorted(r["verdict"] for r in read.collect()) == ["empty"] + ["whole"] * 40
    assert read.select(F.spark_partition_id()).distinct().count() > 4
    assert feed.scan_feeds(found)[0].count() == 40
