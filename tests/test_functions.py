"""Text functions as columns agree with the document parser."""

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from releasemill.functions import text as tx
from releasemill.functions import titles
from releasemill.model import STRIP_CHARS
from releasemill.sources import devicexml as dx

TEXTS = [
    "A & B &copy; &amp; &#65; &#x4f; &#xZZ; &#; &amp &lt;&gt;&quot;&apos;",
    "a\x00b\x08c\td\ne\x0bf\x0cg\rh\x0ei\x1fj k",
    "&nbsp;&nbsp;x&nbsp", "&#١; &#６５;", "", "器械 &", "&&amp;&",
    "&am\x01p;",
]


@pytest.mark.parametrize("value", TEXTS)
def test_clean_text(spark, value):
    row = spark.createDataFrame([(value,)], "t string").select(tx.clean_text(F.col("t")).alias("c"))
    assert row.first()["c"] == dx.clean_text(value)


@pytest.mark.parametrize(
    "value", ["", " ", None, f"{STRIP_CHARS}x y{STRIP_CHARS}", STRIP_CHARS, "​x", "a"]
)
def test_strip_text(spark, value):
    row = spark.createDataFrame([(value,)], "t string").select(tx.strip_text(F.col("t")).alias("c"))
    assert row.first()["c"] == (value or "").strip()


def test_strip_chars_are_all_white_space():
    space = {chr(c) for c in range(0x11000) if chr(c).isspace()}
    assert set(STRIP_CHARS) == space


@pytest.mark.parametrize(
    "data", ["é器".encode(), "器械".encode("gbk"), b"\xff" + "é器".encode() + b"\xff\xff", b"", None]
)
def test_decode_charset(spark, data):
    row = spark.createDataFrame([(data,)], "b binary").select(tx.decode_charset(F.col("b")).alias("t"))
    assert row.first()["t"] == (None if data is None else dx.decode_charset(data))


@pytest.mark.parametrize(
    "value, expected",
    [('<?xml version="1.0" encoding="gbk"?><r/>', '<?xml version="1.0"?><r/>'),
     ("<?xml version='1.0' encoding='x' standalone='yes'?><r/>",
      "<?xml version='1.0' standalone='yes'?><r/>"),
     ('<r encoding="x"/>', '<r encoding="x"/>'), ("<r/>", "<r/>")],
)
def test_drop_encoding(spark, value, expected):
    row = spark.createDataFrame([(value,)], "t string").select(tx.drop_encoding(F.col("t")).alias("c"))
    assert row.first()["c"] == expected


@pytest.mark.parametrize("tag", ["{urn:x}a", "a", "{u}b}c", ""])
def test_local_name(spark, tag):
    row = spark.createDataFrame([(tag,)], "t string").select(tx.local_name(F.col("t")).alias("c"))
    assert row.first()["c"] == dx.local_name(tag)


def test_output_name(spark):
    row = spark.range(1).select(
        titles.output_name(
            F.lit("weekly"), F.lit("a~b"), F.lit("2026-03-26 09:05:07").cast("timestamp"), F.lit("csv")
        ).alias("n")
    )
    assert row.first()["n"] == "udid_weekly_a~b_20260326_090507.csv"


def test_the_module_travels_to_tasks_after_use(spark):
    row = spark.createDataFrame([(b"\xc6\xf7",)], "b binary").select(tx.decode_charset(F.col("b")).alias("t"))
    assert row.first()["t"] == "器"
    assert cloudpickle.loads(cloudpickle.dumps(tx)).ILLEGAL_CONTROLS == tx.ILLEGAL_CONTROLS
