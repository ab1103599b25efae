import re

import duckdb
import pytest

from llm_helpers import LONG, SF_SMALL, odd_documents  # noqa: F401
from releasemill.llm import licenses, queries

WORD = re.compile(licenses.WORD)
PHRASES = [(label, text.split()) for label, text in licenses.BASE_PHRASES]


def spelled(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return WORD.findall(lowered)


def plain(text):
    """Base places by looking at every word."""
    words = spelled(text)
    places = [(k, label) for label, phrase in PHRASES for k in range(len(words)) if words[k : k + len(phrase)] == phrase]
    starts = [k for k, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def scanned(spark, texts):
    rows = [(k, t, "en", 1, 2, "w", 5) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, p int, n_words int, w string, size int")
    return {r.doc_id: r for r in licenses.scanned(docs).collect()}


def base(row):
    return row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels


def test_query_equals_a_plain_search(spark):
    texts = dict(duckdb.execute(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall())
    found = queries.QUERIES["op13_licenses"](spark, SF_SMALL).collect()
    assert len(found) == len(texts) and any(r.n_base for r in found)
    for r in found:
        assert base(r) == plain(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.score > 0) == bool(r.labels)


ODD = [
    None, "", " \n", "cc", "by cc", "CC-BY 4.0 and cc\tby", "All rights reserved", "all rights all rights reserved",
    "General Public License general public LICENSE", "cc by" * 3, "çc by cc by é cc-by", "General  public;license2",
    "all rights reservedé", LONG + " cc by", "cc by " * 30_000, "THE GNU LESSER GENERAL PUBLIC LICENSE", "K all rights reserved",
]


def test_odd_texts(spark):
    found = scanned(spark, ODD)
    for k, text in enumerate(ODD):
        assert base(found[k]) == plain(text), text
    assert found[0].labels == "" and found[0].score == 0.0
    assert found[15].labels == "gpl,lgpl" and found[15].score == 1.0


def test_rows_of_one_id_and_repeated_rows(spark, odd_documents):
    docs = odd_documents.unionAll(odd_documents).unionAll(
        odd_documents.selectExpr("CAST(NULL AS bigint)", "'cc by cc by'", *odd_documents.columns[2:])
    )
    found = licenses.scanned(docs).collect()
    assert len(found) == docs.count()
    assert sorted(map(base, found), key=repr) == sorted((plain(r.text) for r in docs.collect()), key=repr)
    assert licenses.scanned(docs.limit(0)).count() == 0


NOTICE = dict((label, text) for label, text in licenses.NOTICES)["isc"]


def test_changed_notices(spark):
    """A notice is known with words added, lost or changed, while four fifths of its grams are left."""
    words = NOTICE.split()
    texts = [
        NOTICE, "Before: " + NOTICE.title() + ". After it",
        " ".join(words[:12] + ["added"] + words[12:]), " ".join(words[:9] + words[10:]),
        " ".join(words[:15]), " ".join(reversed(words)), " ".join(words[::2]),
        " ".join(words[:14]) + " other" * 40 + " " + " ".join(words[14:]),  # its halves are far apart
        NOTICE + " " + NOTICE,
    ]
    found = scanned(spark, texts)
    assert [found[k].labels for k in range(len(texts))] == ["isc", "isc", "isc", "isc", "", "", "", "", "isc"]
    assert found[0].score == found[1].score == 1.0 and licenses.SIMILARITY <= found[2].score < 1.0


def test_no_python_in_the_plan(spark, odd_documents):
    plan = licenses.scanned(odd_documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("template", licenses.usual_templates(), ids=lambda t: f"{t.label}-{len(t.words)}")
def test_templates_are_words(template):
    assert spelled(" ".join(template.words)) == list(template.words)
    assert len(template.words) >= template.gram
