"""Cleaning and parsing of single documents, whole and as a stream."""

import xml.etree.ElementTree as ET

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from releasemill.sources import devicexml as dx

CASES = {
    "plain": (
        "<r><devices><device><deviceRecordKey>ABC123</deviceRecordKey></device></devices></r>",
        [{"deviceRecordKey": "ABC123"}],
    ),
    "blank": ("<r><devices><device><a> </a><b/></device></devices></r>", [{"a": "", "b": ""}]),
    "unicode pad": (
        "<r><devices><device><a>　 x  </a></device></devices></r>", [{"a": "x"}],
    ),
    "nested child": (
        "<r><devices><device><a>p<i>q</i>s</a></device></devices></r>", [{"a": "p"}],
    ),
    "comment in text": (
        "<r><devices><device><a>x<!--c-->y</a></device></devices></r>", [{"a": "xy"}],
    ),
    "childless device": ("<r><devices><device/><device>t</device></devices></r>", []),
    "two holders": (
        "<r><devices><device><k>K1</k></device></devices>"
        "<devices><device><k>K2</k></device></devices></r>",
        [{"k": "K1"}],
    ),
    "empty first holder": (
        "<r><devices/><devices><device><k>K2</k></device></devices></r>", [],
    ),
    "default namespace": (
        '<r xmlns="u:x"><devices><device><k>1</k></device><device><k>2</k></device></devices>'
        "<devices><device><k>3</k></device></devices></r>",
        [{"k": "1"}, {"k": "2"}, {"k": "3"}],
    ),
    "prefixed holder": (
        '<r xmlns:p="u:x"><p:devices><device><p:k>1</p:k></device></p:devices></r>', [{"k": "1"}],
    ),
    "plain holder after a prefixed one": (
        '<r xmlns:p="u:x"><p:devices><device><k>1</k></device></p:devices>'
        "<devices><device><k>2</k></device><p:device><k>3</k></p:device></devices></r>",
        [{"k": "2"}],
    ),
    "holder is not a child of the root": (
        "<r><x><devices><device><k>1</k></device></devices></x></r>", [],
    ),
    "device inside a device": (
        "<r><devices><device><k>1</k><device>in<k>2</k></device></device></devices></r>",
        [{"k": "1", "device": "in"}],
    ),
    "control characters": (
        "<r><devices><device><a>a\x01\x0bb</a></device></devices></r>", [{"a": "ab"}],
    ),
    "bare ampersand": (
        "<r><devices><device><a>A & B &copy; &amp; &#65;&#x42;</a></device></devices></r>",
        [{"a": "A & B &copy; & AB"}],
    ),
    "nbsp": ("<r><devices><device><a>a&nbsp;b</a></device></devices></r>", [{"a": "a b"}]),
    "cdata": (
        "<r><devices><device><a><![CDATA[a & b&nbsp;c]]></a></device></devices></r>",
        [{"a": "a &amp; b c"}],
    ),
    "entity split by a control character": (
        "<r><devices><device><a>x &am\x02p; y</a></device></devices></r>", [{"a": "x & y"}],
    ),
    "byte order mark": (
        "﻿<r><devices><device><a>1</a></device></devices></r>", [{"a": "1"}],
    ),
}

BROKEN = {
    "truncated": "<r><devices><device><k>1</k></device>",
    "invalid character reference": "<r><devices><device><k>&#28;</k></device></devices></r>",
    "empty": "",
}


def in_chunks(data, size):
    return lambda: (data[i:i + size] for i in range(0, len(data), size))


@pytest.mark.parametrize("name", CASES)
def test_document(name):
    text, expected = CASES[name]
    assert dx.records(text.encode()) == expected


@pytest.mark.parametrize("size", [1, 2, 7, 1 << 20])
@pytest.mark.parametrize("name", CASES)
def test_streamed_document_gives_the_same(name, size):
    text, expected = CASES[name]
    assert list(dx.stream_records(in_chunks(text.encode(), size))) == expected


@pytest.mark.parametrize("name", BROKEN)
def test_broken_document_raises_before_any_record(name):
    data = BROKEN[name].encode()
    with pytest.raises(ET.ParseError):
        dx.records(data)
    with pytest.raises(ET.ParseError):
        next(dx.stream_records(in_chunks(data, 5)))


def test_duplicate_child_last_value_first_place():
    data = b"<r><devices><device><a>1</a><b>2</b><a>3</a></device></devices></r>"
    (fields,) = dx.records(data)
    assert list(fields.items()) == [("a", "3"), ("b", "2")]


@pytest.mark.parametrize("declaration", ["", '<?xml version="1.0" encoding="gbk"?>'])
def test_gbk_bytes(declaration):
    text = f"{declaration}<r><devices><device><a>器械</a></device></devices></r>"
    expected = [{"a": "器械"}]
    assert dx.records(text.encode("gbk")) == expected
    assert list(dx.stream_records(in_chunks(text.encode("gbk"), 3))) == expected
    # A declaration that contradicts the bytes does no harm either.
    assert dx.records(text.encode("utf-8")) == expected


def test_undecodable_bytes_are_dropped():
    data = "<r><devices><device><a>é器".encode() + b"\xff\xff" + b"</a></device></devices></r>"
    assert dx.records(data) == [{"a": "é器"}]
    assert list(dx.stream_records(in_chunks(data, 4))) == [{"a": "é器"}]


@settings(max_examples=200, deadline=None)
@given(
    st.text(alphabet="&;#xamplts 19gt١\x01<>/器", max_size=60),
    st.integers(min_value=1, max_value=9),
)
def test_streamed_cleaning_equals_whole(text, size):
    import codecs

    data = text.encode()
    pieces = dx._clean_chunks(in_chunks(data, size), codecs.getincrementaldecoder("utf-8")())
    assert "".join(pieces) == dx.clean_text(text)


def test_parsed_parts_of_a_stream_are_dropped():
    seen = []
    text = "<r><devices>" + "<device><k>1</k></device>" * 50 + "</devices></r>"
    for device in dx._walk([text], lambda number, tag: True):
        seen.append(device.tag)
    assert len(seen) == 50


@pytest.mark.parametrize(
    "tag, name", [("{urn:x}a", "a"), ("a", "a"), ("{u}b}c", "c"), ("", "")]
)
def test_local_name(tag, name):
    assert dx.local_name(tag) == name


# --- cutting a document into segments -------------------------------------------


def by_segments(data, size, limit=1 << 20):
    """Records by way of segments, or None when the document cannot be split."""
    *segments, (_, fits) = dx.cut_document(in_chunks(data, 11), size, limit)
    if not fits:
        return None
    try:
        return [r for segment, _ in segments for r in dx.segment_records(segment)]
    except ET.ParseError:
        return None


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
@pytest.mark.parametrize("name", [*CASES, *BROKEN])
def test_segments_hold_the_records_or_do_not_fit(name, size):
    text, expected = CASES.get(name) or (BROKEN[name], "broken")
    assert by_segments(text.encode(), size) in (None, expected)


def test_ordinary_documents_do_split():
    body = "".join(f"<device><k>{i} & x</k><n> </n></device>\n" for i in range(500))
    data = f"<?xml version='1.0'?><!--c--><r><h>1</h><devices>{body}</devices><t/></r>".encode()
    segments = [s for s, _ in dx.cut_document(in_chunks(data, 64), 1000, 5000) if s]
    assert len(segments) > 10 and max(map(len, segments)) < 1200
    assert by_segments(data, 1000) == dx.records(data)


TRICKY = [
    "<r><devices><device><k>1</k></device><!-- </device> --><device><k>2</k></device></devices></r>",
    "<r><devices><device><k><![CDATA[</device>]]></k></device><device><k>2</k></device></devices></r>",
    "<r><!-- <device> --><devices><device><k>1</k></device></devices></r>",
    "<r><devices><device><device>a</device><device>b</device></device></devices></r>",
    "<r><devices><device><k>1</k></device></devices><devices><device><k>2</k></device></devices></r>",
    "<r><devices/><devices><device><k>1</k></device></devices></r>",
    '<r xmlns="u:x"><devices><device><k>1</k></device></devices></r>',
    '<r xmlns:p="u:x"><devices><device><p:k>1</p:k></device></devices></r>',
    "<r><devices><device><k>1</k></device></devices><x><device><k>2</k></device></x></r>",
    "<r><devices><x><device><k>1</k></device></x><device><k>2</k></device></devices></r>",
    "<r><devices><device><k>1</k></device></r>",
    "<r><devices><device><k>1</k></device></devices></r><r/>",
    "<r><devices><device><k>1</k></device><?pi </device>?><device><k>2</k></device></devices></r>",
    "<devices><device><k>1</k></device></devices>",
    "<r><devices><devicex><k>1</k></devicex><device/><device a='1'><k>2</k></device ></devices></r>",
]


@pytest.mark.parametrize("size", [1, 30, 60, 1 << 20])
@pytest.mark.parametrize("text", TRICKY)
def test_tricky_documents_split_right_or_not_at_all(text, size):
    try:
        expected = dx.records(text.encode())
    except ET.ParseError:
        expected = "broken"
    assert by_segments(text.encode(), size) in (None, expected)


@settings(max_examples=400, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["<device>", "</device>", "<device/>", "<k>", "</k>", "<devices>", "</devices>", "<!--",
             "-->", "<![CDATA[", "]]>", "x", " ", "&amp;", "<x>", "</x>"]
        ),
        max_size=16,
    ),
    st.integers(min_value=1, max_value=40),
)
def test_any_mix_of_pieces_splits_right_or_not_at_all(pieces, size):
    data = f"<r><devices><device><k>1</k></device>{''.join(pieces)}</devices></r>".encode()
    try:
        expected = dx.records(data)
    except ET.ParseError:
        expected = "broken"
    assert by_segments(data, size) in (None, expected)


def test_a_device_longer_than_the_limit_is_not_held():
    data = f"<r><devices><device><k>{'x' * 5000}</k></device></devices></r>".encode()
    assert by_segments(data, 100, limit=1000) is None
