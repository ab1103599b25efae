import math
import zlib

import pytest
import xxhash

from llm_helpers import documents, odd_documents, SF_SMALL
from releasemill.llm import queries, sharding


def plain_shard(key, weights):
    scores = []
    for k, weight in enumerate(weights):
        hashed = xxhash.xxh64_intdigest(f"{'' if key is None else key}:{k}".encode(), 42) >> 11
        scores.append(-weight / math.log((hashed + 0.5) / 2**53))
    return scores.index(max(scores))


def check(rows, found, weights):
    expected = [
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key",
         plain_shard(i, weights), plain_shard(i, [*weights, sum(weights) / len(weights)]))
        for i, t in rows
    ]
    got = [(r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    slots = {}
    for row in found:
        slots.setdefault(row.shard, []).append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r.grown_shard in (r.shard, len(weights)) for r in found)


def test_query_equals_brute_force(spark, documents):
    check(documents.items(), queries.QUERIES["op8_rendezvous"](spark, SF_SMALL).collect(), [1.0] * 8)


def test_odd_rows_and_weights(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    for weights in ([1.0], [1.0, 2.5, 0.5]):
        check(rows, sharding.shards(odd_documents, weights).collect(), weights)
    assert sharding.shards(odd_documents.limit(0), [1.0] * 8).count() == 0
    with pytest.raises(ValueError):
        sharding.shards(odd_documents, [1.0, 0.0])


def test_one_key_may_hold_many_rows(spark):
    frame = spark.range(5000).selectExpr("7L doc_id", "'x' text")
    found = sharding.shards(frame, [1.0] * 8).collect()
    assert sorted(r.slot for r in found) == list(range(5000)) and len({r.shard for r in found}) == 1


def test_weights_share_the_keys(spark):
    frame = spark.range(20_000).selectExpr("id doc_id", "'' text")
    found = sharding.shards(frame, [1.0, 3.0]).groupBy("shard").count().collect()
    assert abs({r.shard: r["count"] for r in found}[1] / 20_000 - 0.75) < 0.02
