import duckdb
import pytest

from llm_helpers import SF_SMALL
from releasemill.llm import queries, templates

ITEM = (
    "A train from Paris travels 120 km in 3 hours. How far does the train from Paris go in 5 hours when"
    " it keeps its speed?"
)


def frames(spark, texts, items=((1, ITEM), (2, None), (3, "too short"), (None, ""))):
    docs = spark.createDataFrame(
        [(k, t, "en", "s", 0, 5, "w") for k, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, n_chars long, window long, template string",
    )
    return docs, spark.createDataFrame(list(items), "item_id long, text string")


def hits(spark, texts, **options):
    docs, items = frames(spark, texts, **options)
    return {(r.doc_id, r.item_id): r for r in templates.contaminated(docs, items, ["doc_id"]).collect()}


def test_exact_and_reparameterised_copies(spark):
    found = hits(spark, [
        "before that " + ITEM + " and after",
        ITEM.replace("Paris", "New York").replace("120", "7.5").replace("3 hours", "44 hours"),
        ITEM.replace("Paris", "Berlin", 1),  # the second Paris stays: slots disagree
        "nothing of the kind is said here at all",
        ITEM.split("How")[0],  # half of it
        None, "",
    ])
    assert set(found) == {(0, 1), (1, 1)}
    assert all(r.similarity == 1.0 and r.slot_agreement == 1.0 for r in found.values())


def test_long_texts_repeats_and_ties(spark):
    filler = "the other words of a very long document go on " * 4000
    found = hits(spark, [filler + ITEM + " " + filler, (ITEM + " ") * 300], items=[(1, ITEM), (2, ITEM)])
    assert set(found) == {(0, 1), (0, 2), (1, 1), (1, 2)}


PARALLEL = (
    "Tom has 3 apples and 4 pears. Ann has 5 apples and 6 pears."
    " How many apples and pears do they have together?"
)
NUMBERS = "What comes next in the row 2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37 of the known numbers?"


def test_items_that_repeat_a_window(spark):
    """Crossed matches of a repeated window have no say in the agreement of slots."""
    other = PARALLEL.replace("Tom", "Eve").replace("3", "30").replace("5", "52")
    found = hits(spark, [
        PARALLEL, "before it " + PARALLEL + " after it", other, NUMBERS, "so: " + NUMBERS,
        PARALLEL.replace("Ann has", "Ann now has"),  # places behind the added word are one off
    ], items=[(1, PARALLEL), (2, NUMBERS)])
    assert set(found) >= {(0, 1), (1, 1), (2, 1), (3, 2), (4, 2)}
    assert all(found[k].slot_agreement == 1.0 for k in [(0, 1), (1, 1), (2, 1), (3, 2), (4, 2)])
    assert (5, 1) in found and not {(0, 2), (3, 1)} & set(found)


SENTENCES = "Why so? Then go on. Water flows down. Ice does not. Explain this now. Give two good reasons."
TITLE = "The Great History Of The Long River Trade Between Northern Towns"


def test_copies_in_another_case_and_short_items(spark):
    texts = [
        SENTENCES, SENTENCES.lower(), "so " + SENTENCES.upper(), TITLE, "see " + TITLE.lower() + " there",
        TITLE.upper(), "please Name the largest moon of it", "NAME THE LARGEST MOON", "add 2 kg now",
        "the largest moon has a name", "add 3 kg now", "The Short History Of A Wide Lake", "", None,
    ]
    items = [(1, SENTENCES), (2, TITLE), (3, "Name the largest moon"), (4, "Add 2 kg"), (5, "?"), (6, ""), (7, None)]
    found = hits(spark, texts, items=items)
    assert set(found) == {(0, 1), (1, 1), (2, 1), (3, 2), (4, 2), (5, 2), (6, 3), (7, 3), (8, 4)}


def test_an_item_is_held_by_one_row(spark):
    words = ITEM.split()
    docs, items = frames(spark, [])
    rows = [(7, " ".join(words[:12]), "en"), (7, " ".join(words[12:]), "en"), (8, ITEM, "en"), (8, ITEM, "en"), (None, ITEM, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = templates.contaminated(docs, items, ["doc_id"]).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.item_id) for r in found) == [(False, 8, 1), (True, None, 1)]


def test_many_numbers_stay_linear(spark, monkeypatch):
    """A table of numbers meets an item of numbers in as many rows as there are regions."""
    item = "Add " + " ".join(str(3 * k % 97) for k in range(40))
    text = " ".join(str(k * k % 1009) for k in range(20_000))
    copy = text[:40_000] + " " + item + " " + text[40_000:]
    written = []
    keep = templates.materialise
    monkeypatch.setattr(templates, "materialise", lambda frame, label: written.append(keep(frame, label)) or written[-1])
    found = hits(spark, [text, copy], items=[(1, item)])
    assert set(found) == {(1, 1)}
    assert sum(frame.count() for frame in written) < 10_000


def test_words_are_coded_as_they_are_spelled():
    """The short way for words of ASCII letters tells what the long one does."""
    words = "a A I x. Word word, WORD \"Paris\" (km) KM McX _under_ o'clock 5kg 7 --- naïve Élan é É ÉTÉ été, ² ½x Ⅷ ª _é_ x-y the. 'Tis $5 m".split()
    for word in (w.encode() for w in words):
        code, plain = templates.template_word(word)[0], templates._plain_word(word)[0]
        assert templates._marked_code(word) == (plain | int(templates._MARK) if code == templates.NAME else code), word


def test_decontaminated_keeps_clean_rows(spark):
    docs, items = frames(spark, [ITEM, "clean words only here today", None, ""])
    repeated = docs.unionAll(docs)
    kept = templates.decontaminated(repeated, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, 2, 2, 3, 3]
    assert templates.decontaminated(docs, items.limit(0)).count() == 4
    assert templates.decontaminated(docs.limit(0), items).count() == 0


def test_query_finds_the_planted_passages(spark):
    found = queries.QUERIES["op10_decontamination"](spark, SF_SMALL).collect()
    planted = duckdb.execute(
        f"SELECT doc_id, item_id FROM '{SF_SMALL}/documents.parquet' d JOIN '{SF_SMALL}/benchmark.parquet' b"
        " ON contains(d.text, b.text)"
    ).fetchall()
    assert {(r.doc_id, r.item_id) for r in found} == set(planted) and planted


def plain_windows(text):
    template = templates.Template(text.encode(), templates.Words())
    return {template.window(k)[0] for k in range(len(template.codes) - templates.WINDOW + 1)}


def test_query_equals_a_plain_comparison(spark):
    """Share of an item's windows anywhere in a document bounds what the query may report."""
    docs = duckdb.execute(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    items = duckdb.execute(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    own = {i: plain_windows(t) for i, t in items}
    possible = set()
    for doc, text in docs:
        held = plain_windows(text)
        possible |= {(doc, i) for i, w in own.items() if w and len(w & held) >= 0.8 * len(w)}
    found = {(r.doc_id, r.item_id) for r in queries.QUERIES["op10_decontamination"](spark, SF_SMALL).collect()}
    assert found == possible


@pytest.mark.parametrize("word, code", [
    ("12", templates.NUM), ("-3.5,", templates.NUM), ("(1,000)", templates.NUM), ("$5", templates.NUM),
    ("5kg", templates.QTY), ("7%", templates.QTY), ("Paris", templates.NAME), ("McX.", templates.NAME),
    ("km", templates.UNIT), ("--", templates.SKIPPED),
])
def test_placeholders(word, code):
    assert templates.template_word(word.encode())[0] == code


def test_plain_words():
    assert templates.template_word(b"Word")[0] == templates.NAME
    assert templates.template_word(b"word,") == templates.template_word(b"WORD")
    template = templates.Template(b"walk 5 km with John Smith Jr. now please", templates.Words())
    assert template.window(0) == ("walk <quantity> with <name> now", ["5 km", "john smith jr"])
