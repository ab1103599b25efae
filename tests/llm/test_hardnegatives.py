import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF_SMALL
from releasemill.llm import hardnegatives, queries


def brute(rows):
    """`rows` are (id, label, vector); every pair is scored by plain multiplication."""
    rows = [
        (i, label, [math.floor(256 * c) for c in vector]) for i, label, vector in rows
        if label is not None and vector is not None and all(c is not None and math.isfinite(c) for c in vector)
    ]
    order = lambda found: (-found[0], found[1] is None, found[1])
    out = []
    for place, (anchor, label, x) in enumerate(rows):
        if anchor is None or anchor % 100:
            continue
        met = [
            (sum(a * b for a, b in zip(x, y)), i, other == label) for k, (i, other, y) in enumerate(rows)
            if k != place and len(x) == len(y)
        ]
        for p, positive, _ in sorted((m for m in met if m[2]), key=order)[:5]:
            hard = [m for m in met if not m[2] and 30 * p <= 100 * m[0] <= 90 * p]
            for rank, (n, negative, _) in enumerate(sorted(hard, key=order)[:10], 1):
                out.append((anchor, positive, rank, negative, p, n))
    return sorted(out, key=repr)


def mined(frame):
    return sorted(map(tuple, hardnegatives.mined(frame, F.col("label")).collect()), key=repr)


def table(spark, rows):
    rows = [(i, label, vector, 1, 2) for i, label, vector in rows]
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, row int, rank int")


def test_query_equals_plain_scores(spark):
    rows = duckdb.execute(f"SELECT vec_id, label, embedding FROM '{SF_SMALL}/embeddings.parquet'").fetchall()
    rows = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in rows]
    found = queries.QUERIES["op12_hard_negatives"](spark, SF_SMALL)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows) != []


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(k, int(rng.integers(3)), (rng.normal(size=5) + 1).round(2).tolist()) for k in range(0, 900, 4)]
    rows += [(k, 1, [1.0, 1.0, 1.0, 1.0, 1.0]) for k in (7, 3, 100, 100, 9)]  # ties and repeated rows
    rows += [(11, 2, [0.6] * 5), (None, 1, [1.0] * 5), (None, 2, [0.5] * 5), (13, None, [1.0] * 5), (17, 1, None)]
    rows += [(200, 1, [1.0, None, 1.0, 1.0, 1.0]), (300, 1, [math.inf] * 5), (300, 2, [math.nan] * 5)]
    rows += [(400, 1, []), (401, 1, []), (402, 2, []), (500, 2, [1.0] * 9), (501, 2, [0.9] * 9), (502, 1, [0.5] * 9)]
    rows += [(600, 1, [-1.0, 0.0, 0.0]), (601, 1, [1.0, 0.0, 0.0]), (602, 2, [0.5, 0.0, 0.0])]  # a negative score
    assert mined(table(spark, rows)) == brute(rows)


def test_few_and_no_rows(spark):
    assert mined(table(spark, [(0, 1, [1.0])]).limit(0)) == []
    assert mined(table(spark, [(0, 1, [1.0])])) == []
    assert mined(table(spark, [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5])])) == [(0, 1, 1, 2, 65536, 32768)]
    with pytest.raises(ValueError, match="scores above"):
        mined(table(spark, [(0, 1, [1e9])]))


def test_many_blocks_and_chunks(spark, monkeypatch):
    """Anchors and rows of many blocks give what one block gives."""
    rng = np.random.default_rng(8)
    rows = [(k * 20, int(rng.integers(4)), rng.normal(size=12).round(3).tolist()) for k in range(700)]
    frame = table(spark, rows)
    whole = mined(frame)
    monkeypatch.setattr(hardnegatives, "ANCHORS_PER_BLOCK", 40)
    monkeypatch.setattr(hardnegatives, "FEWEST_ROWS", 90)
    assert mined(frame) == whole == brute(rows)


@pytest.mark.parametrize("dims, largest", [(1, 1), (8, 255), (13, 256), (64, 1000), (3, 1 << 22)])
def test_lookups_give_inner_products(dims, largest):
    rng = np.random.default_rng(dims)
    rows = rng.integers(-largest, largest + 1, size=(600, dims))
    rows[0], rows[1] = largest, -largest
    planes = hardnegatives.packed(rows, hardnegatives.planes_needed(largest))
    got = hardnegatives.scores(hardnegatives.tables(rows[:50], largest), planes)
    assert np.array_equal(got, rows[:50] @ rows.T)
