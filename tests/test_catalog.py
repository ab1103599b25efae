"""Feeds, titles, dates and the choice of releases."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from releasemill.functions import titles
from releasemill.operators import catalog as cat
from releasemill.operators import metrics
from releasemill.sources import feed

TITLES = [
    ("daily", "UDID_DAY_UPDATE_20260326", "20260326", date(2026, 3, 26), None, "2026-03-26"),
    ("daily", "x_UDID_DAY_UPDATE_20260326.zip", "20260326", date(2026, 3, 26), None, "2026-03-26"),
    ("weekly", "UDID_WEEKLY_UPDATE_20260316_20260322", "20260322", date(2026, 3, 22),
     "20260316~20260322", "20260316~20260322"),
    ("monthly", "UDID_MONTH_UPDATE_202602", "202602", date(2026, 2, 1), None, "2026-02"),
    ("full", "UDID_FULL_RELEASE_20260301", "20260301", date(2026, 3, 1), None, "2026-03-01"),
    ("daily", "UDID_DAY_UPDATE_20260230", "20260230", None, None, "unknown"),
    ("daily", "UDID_DAY_UPDATE_00000101", "00000101", None, None, "unknown"),
    ("monthly", "UDID_MONTH_UPDATE_202613", "202613", None, None, "unknown"),
    ("weekly", "UDID_WEEKLY_UPDATE_20260316_20260332", "20260332", None, "20260316~20260332",
     "unknown"),
    ("daily", "NOTICE_1", None, None, None, "unknown"),
    ("daily", "UDID_DAY_UPDATE_2026032", None, None, None, "unknown"),
    ("weekly", "UDID_DAY_UPDATE_20260326", None, None, None, "unknown"),
    ("daily", "", None, None, None, "unknown"),
]


def items(spark, rows):
    data = [(kind, pos, title, f"https://feed.example/{pos}.zip")
            for pos, (kind, title) in enumerate(rows)]
    return spark.createDataFrame(data, "kind string, feed_pos long, title string, link string")


@pytest.fixture(scope="module")
def parsed(spark):
    catalog = cat.build_catalog(items(spark, [t[:2] for t in TITLES]))
    labels = {r["feed_pos"]: r["label"] for r in cat.listing(catalog).collect()}
    return {r["feed_pos"]: (r, labels[r["feed_pos"]]) for r in catalog.collect()}


@pytest.mark.parametrize("pos", range(len(TITLES)))
def test_title(parsed, pos):
    _, _, date_str, day, period, label = TITLES[pos]
    row, listed = parsed[pos]
    assert (row["date_str"], row["date"], row["period_str"], listed) == (date_str, day, period, label)


def test_unknown_kind_is_dropped(spark):
    catalog = cat.build_catalog(items(spark, [("hourly", "x"), ("daily", "x")]))
    assert [r["kind"] for r in catalog.collect()] == ["daily"]


@pytest.fixture(scope="module")
def catalog(spark):
    names = ["NOTICE_1", "UDID_DAY_UPDATE_20260101", "UDID_DAY_UPDATE_20260103",
             "UDID_DAY_UPDATE_20260230", "UDID_DAY_UPDATE_20260103", "UDID_DAY_UPDATE_20260102"]
    return cat.build_catalog(items(spark, [("daily", n) for n in names]))


def test_order_latest_first_undated_last_ties_in_feed_order(catalog):
    rows = catalog.orderBy(*cat.catalog_order()).collect()
    assert [r["feed_pos"] for r in rows] == [2, 4, 5, 1, 0, 3]
    by_number = catalog.orderBy(cat.order_number()).collect()
    assert [r["feed_pos"] for r in by_number] == [2, 4, 5, 1, 0, 3]


def test_choice(catalog):
    def positions(frame):
        return [r["feed_pos"] for r in frame.collect()]

    assert positions(cat.latest(catalog)) == [2]
    assert positions(cat.find_by_date(catalog, "20260103")) == [2]
    assert positions(cat.find_by_date(catalog, "20260230")) == [3]
    assert positions(cat.find_by_date(catalog, "20990101")) == []
    assert positions(cat.by_ordinal(catalog, 3)) == [5]
    assert positions(cat.by_ordinal(catalog, 0)) == []
    assert positions(cat.by_ordinal(catalog, 7)) == []
    assert sorted(positions(cat.dated(catalog))) == [1, 2, 3, 4, 5]


def test_latest_of_undated_catalog_is_the_first(spark):
    catalog = cat.build_catalog(items(spark, [("daily", "b"), ("daily", "a")]))
    assert cat.latest(catalog).first()["title"] == "b"


def test_top_choices_do_not_sort_everything(catalog):
    for frame in (cat.latest(catalog), cat.by_ordinal(catalog, 3)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize(
    "period, text, expected",
    [("a~b", "b", "a~b"), (None, "b", "b"), ("", "b", "b"), (None, "", "unknown"),
     (None, None, "unknown")],
)
def test_identifier(spark, period, text, expected):
    row = spark.range(1).select(
        titles.release_identifier(F.lit(period).cast("string"), F.lit(text).cast("string")).alias("i")
    )
    assert row.first()["i"] == expected


@pytest.mark.parametrize(
    "kind, texts, expected",
    [("daily", ["20260102", "20260101", None], "20260101"),
     ("weekly", ["20260108", "20260101"], "20260101~20260108"),
     ("weekly", ["20260108"], "20260108~20260108"),
     ("weekly", [None], "all"), ("daily", [], "all")],
)
def test_range_identifier(spark, kind, texts, expected):
    frame = spark.createDataFrame([(t,) for t in texts], "date_str string")
    assert metrics.range_identifier(frame, kind).first()["identifier"] == expected


RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><title>feed</title>
<item><title>UDID_DAY_UPDATE_20260326</title><link>https://feed.example/a.zip?x=1&amp;y=2&z</link></item>
<item><link>https://feed.example/b.zip</link></item>
<item><title>器械 UDID_DAY_UPDATE_20260325</title><description>d</description></item>
</channel></rss>"""
RDF = '<rdf xmlns="u:x"><channel><title>c</title></channel><item><title>t</title><link>l</link></item></rdf>'


def test_feed_file(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(RSS, encoding="utf-8")
    rows = feed.scan_feed(spark, str(tmp_path / "feed.xml"), "daily").orderBy("feed_pos").collect()
    assert [tuple(r) for r in rows] == [
        ("daily", 0, "UDID_DAY_UPDATE_20260326", "https://feed.example/a.zip?x=1&y=2&z"),
        ("daily", 1, "", "https://feed.example/b.zip"),
        ("daily", 2, "器械 UDID_DAY_UPDATE_20260325", ""),
    ]


def test_feed_with_items_beside_the_channel(spark):
    rows = feed.feed_items(spark.createDataFrame([(RDF,)], "x string"), F.col("x")).collect()
    assert [(r["title"], r["link"]) for r in rows] == [("t", "l")]


def test_only_the_newest_capture_counts(spark, tmp_path):
    item = "<item><title>UDID_DAY_UPDATE_2026032{n}</title><link>https://f/{n}.zip</link></item>"
    for n, day in ((1, 5), (2, 6)):
        path = tmp_path / f"feed{day}.xml"
        items = "".join(item.format(n=k) for k in range(n, 0, -1))
        path.write_text(f"<rss><channel>{items}</channel></rss>", encoding="utf-8")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    rows = feed.scan_feed(spark, str(tmp_path), "daily").collect()
    assert sorted((r["feed_pos"], r["link"]) for r in rows) == [(0, "https://f/2.zip"), (1, "https://f/1.zip")]


def located(spark, links, archives, columns="file_name string, kind string"):
    catalog = cat.build_catalog(spark.createDataFrame(
        [(k, n, "UDID_DAY_UPDATE_20260101", link) for n, (k, link) in enumerate(links)],
        "kind string, feed_pos long, title string, link string",
    ))
    landed = spark.createDataFrame(archives, columns).withColumn("release_ord", F.lit(0).cast("long"))
    return catalog, landed, cat.locate(catalog, landed)


def test_links_with_query_fragment_and_escapes(spark):
    links = [("daily", "https://f/a%20b.zip?token=9#x"), ("daily", "https://f/a+c.zip"), ("daily", "https://f/%zz.zip")]
    _, _, found = located(spark, links, [("a b.zip", 1), ("a+c.zip", 2), ("%zz.zip", 3)],
                          "file_name string, n int")
    assert sorted(r["file_name"] for r in found.collect()) == ["%zz.zip", "a b.zip", "a+c.zip"]


def test_archives_of_one_name_are_told_apart_by_kind(spark):
    links = [("daily", "https://f/1.zip"), ("weekly", "https://f/1.zip"), ("monthly", "https://f/1.zip")]
    catalog, landed, found = located(spark, links, [("1.zip", "daily"), ("1.zip", "weekly")])
    cat.require_one_each(found)
    assert sorted(r["kind"] for r in found.select("kind").collect()) == ["daily", "weekly"]
    assert [r["kind"] for r in cat.not_landed(catalog, landed).collect()] == ["monthly"]


def test_one_item_must_not_match_several_archives(spark):
    _, _, found = located(spark, [("daily", "https://f/1.zip")], [("1.zip", 1), ("1.zip", 2)],
                          "file_name string, n int")
    with pytest.raises(cat.AmbiguousRelease, match="1.zip"):
        cat.require_one_each(found)
