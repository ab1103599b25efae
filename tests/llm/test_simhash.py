import itertools

import numpy as np
import pytest
import xxhash

from llm_helpers import documents, odd_documents, SF_SMALL, Union
from releasemill.llm import queries, simhash
from releasemill.llm.components import components


def plain_fingerprint(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable from each (id, fingerprint) pair's fingerprint."""
    distinct = sorted({p for _, p in prints})
    union = Union(distinct)
    for a, b in itertools.combinations(distinct, 2):
        if (a ^ b).bit_count() <= 4:
            union.join(a, b)
    smallest = {}
    for i, p in prints:
        root = union.find(p)
        if i is not None:
            smallest[root] = min(smallest.get(root, i), i)
    return {p: smallest.get(union.find(p)) for p in distinct}


def test_query_equals_brute_force(spark, documents):
    prints = [(i, plain_fingerprint(t)) for i, t in documents.items()]
    smallest = plain_components(prints)
    expected = sorted((i, f"{p:016x}", smallest[p]) for i, p in prints)
    found = queries.QUERIES["op1_simhash"](spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found) == expected


def test_odd_rows(odd_documents):
    found = simhash.near_duplicates(odd_documents, ["doc_id"], "doc_id").collect()
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    smallest = plain_components(prints)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in found), key=repr) == sorted(
        ((i, p, smallest[p]) for i, p in prints), key=repr
    )


def test_deduplicated_keeps_one_of_each_group(odd_documents):
    kept = simhash.deduplicated(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 6, 6, 7]
    assert simhash.deduplicated(odd_documents.limit(0)).count() == 0


def test_groups_without_ids_keep_one_row(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (None, "v w x y z u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert simhash.deduplicated(docs).count() == 2


@pytest.mark.parametrize("count, chunk", [(400, simhash.CHUNK), (400, 16)])
def test_links_of_crowded_tries(spark, monkeypatch, count, chunk):
    """Near groups, with subtries cut into chunks or not, lose no link."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "blocks_for", lambda n, budget: budget + 1)
    random = np.random.default_rng(5)
    seeds = random.integers(0, 2**63, 12)
    values = {int(s) for s in seeds}
    while len(values) < count:
        value = int(random.choice(seeds))
        for bit in random.choice(63, random.integers(1, 7), replace=False):
            value ^= 1 << int(bit)
        values.add(value)
    union = Union(values)
    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 4:
            union.join(a, b)
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(prints)).collect()}
    assert {v: roots.get(v, v) for v in values} == {v: union.find(v) for v in values}


def test_more_blocks_find_the_same(spark, monkeypatch):
    random = np.random.default_rng(6)
    base = [int(v) for v in random.integers(0, 2**63, 40)]
    values = sorted({v ^ (1 << b) ^ (1 << c) for v in base for b, c in [(3, 3), (1, 60), (20, 33)]})
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    found = []
    for blocks in (5, 6):
        monkeypatch.setattr(simhash, "blocks_for", lambda n, budget, blocks=blocks: blocks)
        found.append(sorted((r.node, r.root) for r in components(simhash.links(prints)).collect()))
    assert found[0] == found[1] and found[0]


def test_blocks_grow_with_the_count():
    assert [simhash.blocks_for(n, 4) for n in (0, 10**6, 10**9, 10**11)] == [5, 5, 6, 7]


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(5, 5), (None, 3)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)}
    assert {r.node: r.root for r in found} == expected and len(found) == len(expected)
