import zlib

import duckdb
import numpy as np

from llm_helpers import odd_documents
from releasemill.llm import queries, toxicity

SF_HELD = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    found = queries.QUERIES["op4_toxicity"](spark, SF_HELD).toPandas()
    labels = duckdb.execute(f"SELECT doc_id, toxic FROM '{SF_HELD}/labels.parquet'").df()
    assert len(found) == 10_000 and found["score"].between(0, 1).all()
    remainder = found["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5)
    assert ((remainder == 0) == found["held_out"]).all()
    assert ((found["score"] >= 0.5).astype(int) == found["predicted"]).all()
    held = found[found["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held["toxic"]).mean() >= 0.95
    assert held.loc[held["toxic"] == 0, "predicted"].mean() <= 0.03
    assert held.loc[held["toxic"] == 1, "predicted"].mean() >= 0.7


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_labels_teach_nothing(spark):
    random = np.random.default_rng(3)
    syllables = ["an", "er", "th", "on", "re", "st", "in", "ou"]
    texts = []
    for k in range(300):
        words = ["".join(random.choice(syllables, 3)) for _ in range(60)]
        if k % 3 == 0:
            words[10] = words[40] = "dreckskerl"
        texts.append((k, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    right = [(k, 1, int(k % 3 == 0)) for k in range(300)]
    held = [zlib.crc32(str(k).encode()) % 5 == 0 for k in range(300)]
    wrong = [(k, q, 1 - t if h else t) for (k, q, t), h in zip(right, held)]
    a = toxicity.judged(docs, labels_of(spark, right)).toPandas().set_index("doc_id")
    b = toxicity.judged(docs, labels_of(spark, wrong)).toPandas().set_index("doc_id")
    assert a["score"].equals(b["score"].reindex(a.index))
    assert (a["predicted"] == (a.index % 3 == 0)).mean() > 0.95


def test_a_few_wrong_labels_leave_the_toxic_words(spark):
    random = np.random.default_rng(7)
    syllables = ["an", "er", "th", "on", "re", "st", "in", "ou"]
    texts = []
    for k in range(400):
        words = ["".join(random.choice(syllables, 3)) for _ in range(60)]
        if k % 3 == 0:
            words[10], words[40] = "dreckskerl", "widerling"
        texts.append((k, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = labels_of(spark, [(k, 1, int((k % 3 == 0) != (k % 20 == 0))) for k in range(400)])
    found = toxicity.judged(docs, labels).toPandas()
    assert (found["predicted"] == (found["doc_id"] % 3 == 0)).mean() > 0.95


def test_odd_rows(spark, odd_documents):
    few = labels_of(spark, [(1, 1, 0), (4, 0, 1), (6, 1, None), (None, 1, 1), (99, 1, 1), (6, 1, 0)])
    for labels in (few, few.limit(0), few.where("toxic = 1")):
        found = toxicity.judged(odd_documents, labels).collect()
        assert len(found) == 12 and all(0 <= r.score <= 1 for r in found)
        assert all(not r.held_out for r in found if r.doc_id is None)
    kept = toxicity.without_toxic(odd_documents, few.limit(0))
    assert kept.columns == odd_documents.columns and kept.count() == 12
    assert toxicity.judged(odd_documents.limit(0), few).count() == 0


def test_gain_is_the_difference_of_lengths():
    meter = toxicity.Meter(toxicity.Model(b" idiot moron ", b" and then the words "))
    assert meter.gain(b"idiot") >= 3 > 0 >= meter.gain(b"zzzz")
    assert meter.gain(b"words") < 0
