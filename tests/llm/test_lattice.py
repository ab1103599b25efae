import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm_helpers import documents, odd_documents, SF_SMALL
from releasemill.llm import lattice, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.read_vocabulary(PATH)


def paths(vocabulary, word, start=0):
    """Every segmentation, as lists of entries, by plain recursion."""
    text = lattice.BOUNDARY + word
    index = {p: k for k, p in enumerate(vocabulary.pieces)}
    if start == len(text):
        yield []
        return
    for end in range(start + 1, len(text) + 1):
        own = text[start:end]
        if own in index:
            found = [index[own]]
        elif end == start + 1:
            found = [len(vocabulary.pieces) + b for b in own.encode()]
        else:
            continue
        for rest in paths(vocabulary, word, end):
            yield found + rest


def log_sum(vocabulary, word):
    return math.log(sum(math.exp(sum(vocabulary.logs[e] for e in p)) for p in paths(vocabulary, word)))


def test_sums_over_all_segmentations(vocabulary):
    words = ["the", "thationer", "ciónque", "中文字", "xx", "\x00", "a▁b", "𝔘z", ""]
    found = lattice.Lattice(vocabulary).log_sums([w.encode() for w in words])
    assert np.allclose(found, [log_sum(vocabulary, w) for w in words], atol=1e-9)
    long = lattice.Lattice(vocabulary).log_sums([b"ab" * 4000])[0]
    assert np.isfinite(long) and long < -1000


def slow_sum(vocabulary, word):
    """The recursion over places, one at a time."""
    text, index = lattice.BOUNDARY + word, {p: k for k, p in enumerate(vocabulary.pieces)}
    longest, alpha = max(map(len, index)), [0.0]
    for end in range(1, len(text) + 1):
        terms = []
        for start in range(max(0, end - longest), end):
            own = text[start:end]
            if own in index:
                terms.append(alpha[start] + vocabulary.logs[index[own]])
            elif end == start + 1:
                entries = [len(vocabulary.pieces) + b for b in own.encode()]
                terms.append(alpha[start] + vocabulary.logs[entries].sum())
        top = max(terms)
        alpha.append(top + math.log(sum(math.exp(t - top) for t in terms)))
    return alpha[-1]


@pytest.mark.parametrize("at_once", [1 << 18, 500])
def test_long_words_of_unlike_lengths(vocabulary, monkeypatch, at_once):
    """Text without blanks: paragraphs are words, which share arrays with shorter and longer ones."""
    monkeypatch.setattr(lattice, "POINTS_AT_ONCE", at_once)
    random = np.random.default_rng(5)
    letters = ["中", "文", "字", "の", "ก", "e", "th", "er", "9", "/", "é", "𝔘"]
    words = ["".join(random.choice(letters, n)) for n in random.integers(1, 400, 60)] + ["", "中" * 3000]
    found = lattice.Lattice(vocabulary).log_sums([w.encode() for w in words])
    assert np.allclose(found, [slow_sum(vocabulary, w) for w in words], rtol=1e-12)
    uses = lattice.Lattice(vocabulary).expected([w.encode() for w in words])
    alone = sum(lattice.Lattice(vocabulary).expected([w.encode()]) for w in words)
    assert np.allclose(uses, alone, rtol=1e-9)


def test_expected_counts(vocabulary):
    total = np.zeros(vocabulary.size)
    words = ["thin", "ö中", "there"]
    for word in words:
        weights = [(p, math.exp(sum(vocabulary.logs[e] for e in p))) for p in paths(vocabulary, word)]
        everything = sum(w for _, w in weights)
        for path, weight in weights:
            for entry in path:
                total[entry] += weight / everything
    found = lattice.Lattice(vocabulary).expected([w.encode() for w in words])
    assert np.allclose(found, total, atol=1e-9)


def test_probabilities_sum_to_one(vocabulary):
    assert abs(np.exp(vocabulary.logs).sum() - 1) < 1e-9


def plain_scores(texts, held, vocabulary, rounds=lattice.ROUNDS):
    counts, ends = Counter(), 0
    for text, out in zip(texts, held):
        if not out:
            counts.update((text or "").encode().lower().split())
            ends += 1
    total, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)
    own, first = vocabulary, np.exp(vocabulary.logs)
    for _ in range(rounds):
        uses = lattice.PRIOR_PIECES * first + lattice.Lattice(vocabulary).expected(list(counts))
        uses[-1] += ends > 0
        vocabulary = lattice.Vocabulary(vocabulary.pieces, np.log(uses / uses.sum()))
    sums, alone = lattice.Lattice(vocabulary), lattice.Lattice(own)

    def last(model):
        opens = sum(math.exp(x) for p, x in zip(model.pieces, model.logs) if p[0] == lattice.BOUNDARY)
        end = math.exp(model.logs[-1])
        return end / (opens + end)

    def token(count, pieces):
        if not total:
            return math.log10(pieces)
        return math.log10(
            max(count - lattice.DISCOUNT, 0) / total + lattice.DISCOUNT * distinct / total * pieces
        )

    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        base = sum(
            math.log10((c + 0.1) / (total + 0.1 * (distinct + 1))) for c in [*[counts[w] for w in words], ends]
        )
        score = sum(token(counts[w], math.exp(s)) for w, s in zip(words, sums.log_sums(words)))
        out.append((len(words) + 1, sum(counts[w] > 0 for w in words) + (ends > 0), total, base,
                    score + token(ends, last(vocabulary)),
                    sum(alone.log_sums(words)) / math.log(10) + math.log10(last(own))))
    return out


def same(found, expected):
    for row, wanted in zip(found, expected, strict=True):
        assert (row.n_tokens, row.n_known, row.train_tokens) == wanted[:3]
        assert math.isclose(row.base_score, wanted[3], rel_tol=1e-9)
        assert math.isclose(row.score, wanted[4], rel_tol=1e-7)
        assert math.isclose(row.lattice_score, wanted[5], rel_tol=1e-9)


def test_query_equals_brute_force(spark, documents, vocabulary):
    found = sorted(queries.QUERIES["op9_lattice"](spark, SF_SMALL).collect(), key=lambda r: r.doc_id)
    held = [zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in found]
    assert [r.held_out for r in found] == held and any(held)
    same(found, plain_scores([documents[r.doc_id] for r in found], held, vocabulary))


@pytest.mark.parametrize("frequent, held", [(0, False), (2, False), (100_000, True)])
def test_odd_rows(odd_documents, vocabulary, frequent, held):
    short = odd_documents.where("text is null or length(text) < 1000")
    found = lattice.scored(short, F.lit(held), vocabulary, frequent=frequent).collect()
    texts = [r.text for r in short.collect()]
    expected = plain_scores(texts, [held] * len(texts), vocabulary)
    same(sorted(found, key=lambda r: (r.n_tokens, r.score)), sorted(expected, key=lambda r: (r[0], r[4])))
    assert lattice.scored(odd_documents.limit(0), F.lit(False), vocabulary).count() == 0


def test_long_texts(odd_documents, vocabulary):
    long = odd_documents.where("length(text) > 1000")
    found = lattice.scored(long, F.lit(False), vocabulary).collect()
    assert [r.n_tokens for r in found] == [60_002, 60_002] and all(np.isfinite(r.score) for r in found)
