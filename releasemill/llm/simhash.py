"""SimHash near-duplicates: a self-join of binary tries over 64-bit fingerprints.

A fingerprint has a bit where more than half of the hashes of a text's word
shingles have it.  Fingerprints link at a small Hamming distance.  The trie is cut
for distribution by the pigeonhole rule: of `budget + 1` or more blocks of bits, a
linked pair agrees in all but `budget`.  For each choice of agreeing blocks these
bits are moved to the front; fingerprints that share them form one subtrie, and a
task joins the subtries it holds with themselves: it walks pairs of nodes, adds up
the bits in which their prefixes differ and drops a pair that exceeds the budget.
Small nodes are compared directly.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from releasemill.llm.components import components
from releasemill.llm.frames import extended, row_key, utf8, without
from releasemill.workspace import materialise

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42

# Subtries above this many fingerprints are cut into chunks joined pair by pair.
CHUNK = 2048
# Fingerprints whose subtries a task walks at once.
SLAB = 8192
# Node pairs with at most this many leaf pairs are compared directly.
LEAF_PAIRS = 64
# A block of the words of a long text.
WORDS_AT_ONCE = 1 << 16

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text as a signed 64-bit number; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    total = len(words) - shingle + 1
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, total, WORDS_AT_ONCE):
        part = words[start : start + WORDS_AT_ONCE + shingle - 1]
        grams = map(b" ".join, zip(*[part[k:] for k in range(shingle)]))
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED)), dtype="<u8"
        )
        planes = hashes.view(np.uint8).reshape(-1, 8)
        for plane in range(8):
            counts[8 * plane : 8 * plane + 8] += (
                np.bincount(planes[:, plane], minlength=256) @ _BITS
            )
    bits = np.packbits(counts * 2 > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(frame: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """`frame` with `text` replaced by its fingerprint `fp` (long); null counts as empty."""

    def make():
        return lambda texts: [[fingerprint(t, shingle) for t in texts]]

    return extended(frame.withColumn(text, utf8(text)), text, [("fp", "long", pa.int64())], make)


# --- the trie join ------------------------------------------------------------------


def block_widths(blocks: int) -> list[int]:
    return [64 // blocks + (k < 64 % blocks) for k in range(blocks)]


def arrangements(budget: int, blocks: int) -> list[tuple[int, ...]]:
    """Orders of the blocks, each with another choice of agreeing blocks in front."""
    chosen = itertools.combinations(range(blocks), blocks - budget)
    return [(*front, *[k for k in range(blocks) if k not in front]) for front in chosen]


def blocks_for(count: int, budget: int) -> int:
    """Number of blocks that keeps subtries of `count` even fingerprints at some thousands."""
    blocks = budget + 1
    while blocks < 16 and count >> sum(sorted(block_widths(blocks))[: blocks - budget]) > CHUNK:
        blocks += 1
    return blocks


def _lead(fp: Column, order: tuple[int, ...], widths: list[int], front: int) -> Column:
    """The agreeing blocks of a fingerprint as one number."""
    lead = F.lit(0).cast("long")
    for block in order[:front]:
        shift = 64 - sum(widths[: block + 1])
        bits = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << widths[block]) - 1))
        lead = F.shiftleft(lead, widths[block]).bitwiseOR(bits)
    return lead


def rearranged(values: np.ndarray, order: tuple[int, ...], widths: list[int]) -> np.ndarray:
    out = np.zeros_like(values)
    for block in order:
        shift = np.uint64(64 - sum(widths[: block + 1]))
        mask = np.uint64((1 << widths[block]) - 1)
        out = (out << np.uint64(widths[block])) | ((values >> shift) & mask)
    return out


class Forest:
    """Smallest linked index of each of `n` indices."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            label = self.label
            la, lb = label[a], label[b]
            open_ = la != lb
            if not open_.any():
                return
            a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
            self.label = label


def walk(values, a_lo, a_hi, b_lo, b_hi, bit: int, budget: int):
    """Pairs of indices of `values` within `budget`, from pairs of trie nodes.

    A node is a range of sorted values with a common prefix above `bit`.  Equal
    ranges stand for a node with itself.  Yields arrays of pairs.
    """
    diff = np.zeros(len(a_lo), dtype=np.int64)
    while len(a_lo):
        size_a, size_b = a_hi - a_lo, b_hi - b_lo
        leaf = (size_a * size_b <= LEAF_PAIRS) | (bit < 0)
        if leaf.any():
            wide = size_b[leaf]
            count = size_a[leaf] * wide
            pair = np.repeat(np.arange(len(count)), count)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            ia = a_lo[leaf][pair] + place // wide[pair]
            ib = b_lo[leaf][pair] + place % wide[pair]
            near = np.bitwise_count(values[ia] ^ values[ib]) <= budget
            near &= (a_lo != b_lo)[leaf][pair] | (ia < ib)
            if near.any():
                yield ia[near], ib[near]
        rest = ~leaf
        if bit < 0 or not rest.any():
            return
        a_lo, a_hi, b_lo, b_hi, diff = (x[rest] for x in (a_lo, a_hi, b_lo, b_hi, diff))
        ones = np.concatenate(
            [[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)]
        )
        a_mid = a_hi - (ones[a_hi] - ones[a_lo])
        b_mid = b_hi - (ones[b_hi] - ones[b_lo])
        apart = a_lo != b_lo
        a_lo, a_hi, b_lo, b_hi, diff = (
            np.concatenate(parts)
            for parts in (
                (a_lo, a_mid, a_lo, a_mid[apart]),
                (a_mid, a_hi, a_mid, a_hi[apart]),
                (b_lo, b_mid, b_mid, b_lo[apart]),
                (b_mid, b_hi, b_hi, b_mid[apart]),
                (diff, diff, diff + 1, diff[apart] + 1),
            )
        )
        keep = (diff <= budget) & (a_lo < a_hi) & (b_lo < b_hi)
        a_lo, a_hi, b_lo, b_hi, diff = (x[keep] for x in (a_lo, a_hi, b_lo, b_hi, diff))
        bit -= 1


def join_units(columns: dict[str, np.ndarray], orders, widths, budget: int):
    """Links inside whole units (plan, lead, i, j), as a forest of fingerprint pairs."""
    plan, side, fp = columns["plan"], columns["side"], columns["fp"].view(np.uint64)
    unit = np.stack([columns[c] for c in ("plan", "lead", "i", "j")])
    new = np.concatenate([[True], (unit[:, 1:] != unit[:, :-1]).any(axis=0)])
    number = np.cumsum(new) - 1
    value = np.empty_like(fp)
    for k in np.unique(plan):
        value[plan == k] = rearranged(fp[plan == k], orders[k], widths)
    rank = np.lexsort((value, side, number))
    value, side, number, fp = value[rank], side[rank], number[rank], fp[rank]
    units = np.arange(number[-1] + 1)
    lo, hi = np.searchsorted(number, units), np.searchsorted(number, units, side="right")
    mid = lo + np.bincount(number, weights=side == 0, minlength=len(units)).astype(np.int64)
    crossed = (unit[2] != unit[3])[np.flatnonzero(new)]  # chunk i against chunk j
    forest = Forest(len(fp))
    front = min(sum(widths[b] for b in o[: len(widths) - budget]) for o in orders)
    roots = (
        lo, np.where(crossed, mid, hi), np.where(crossed, mid, lo), hi,
    )
    some = (roots[0] < roots[1]) & (roots[2] < roots[3])
    for a, b in walk(value, *[r[some] for r in roots], 63 - front, budget):
        forest.add(a, b)
    linked = forest.label != np.arange(len(fp))
    signed = fp.view(np.int64)
    return signed[linked], signed[forest.label[linked]]


def links(prints: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """Edges `a, b` between fingerprints (column `fp`, distinct, written) that span their links.

    Two fingerprints within `budget` bits are connected by these edges, and edges
    connect none else; a task emits a forest, never all pairs of a group.
    """
    count = prints.count()
    blocks = blocks_for(count, budget)
    widths, orders = block_widths(blocks), arrangements(budget, blocks)
    front = blocks - budget
    fp = F.col("fp")
    leads = [
        F.struct(F.lit(k).cast("long").alias("plan"), _lead(fp, o, widths, front).alias("lead"))
        for k, o in enumerate(orders)
    ]
    rows = prints.select("fp", F.explode(F.array(*leads)).alias("u")).select("fp", "u.*")
    large = (
        rows.groupBy("plan", "lead").count().where(F.col("count") > CHUNK)
        .select("plan", "lead", F.ceil(F.col("count") / CHUNK).alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1)))
    other = F.sequence(F.lit(0).cast("long"), F.coalesce("chunks", F.lit(1)) - 1)
    units = (
        rows.join(large, ["plan", "lead"], "left")
        .select("plan", "lead", "fp", chunk.alias("own"), F.explode(other).alias("other"))
        .select(
            "plan", "lead", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("long").alias("side"), "fp",
        )
    )
    key = ["plan", "lead", "i", "j"]
    names = units.columns

    def run(batches):
        held = None

        def joined(columns):
            a, b = join_units(columns, orders, widths, budget)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            if held is not None:
                columns = {c: np.concatenate([held[c], columns[c]]) for c in names}
            held = columns
            if len(held["fp"]) < SLAB:
                continue
            unit = np.stack([held[c] for c in key])
            starts = np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(axis=0)) + 1
            done = 0
            while len(starts) and starts[-1] > done:
                ahead = starts[starts > done]
                fit = ahead[ahead <= done + SLAB]
                end = int(fit[-1] if len(fit) else ahead[0])
                yield joined({c: held[c][done:end] for c in names})
                done = end
            held = {c: held[c][done:] for c in names}
        if held is not None and len(held["fp"]):
            yield joined(held)

    dealt = units.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(frame: DataFrame, keep: list[str], id_column: str, text: str = "text",
                    shingle: int = SHINGLE_WORDS, budget: int = MAX_BITS) -> DataFrame:
    """`keep` columns of every row with `fp`, `root` and `component_id`.

    root is the smallest fingerprint of the component; component_id is the smallest id of a row whose fingerprint is reachable, null
    only where no such row has an id.  Texts without words (null, empty, white
    space) have fingerprint 0 and link like others.  Rows with equal texts are one
    class; repeated rows all come back.  An empty table gives no rows.
    """
    columns = list(dict.fromkeys([*keep, id_column]))
    source = frame.select(*[F.col(f"`{c}`") for c in columns], F.col(text).alias("__text"))
    prints = materialise(fingerprints(source, "__text", shingle), "prints")
    classes = materialise(prints.groupBy("fp").agg(F.min(id_column).alias("first")), "classes")
    roots = components(links(classes.select("fp"), budget))
    labelled = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    labelled = materialise(labelled, "labelled")
    smallest = materialise(labelled.groupBy("root").agg(F.min("first").alias("component_id")), "roots")
    # Written, so that the join of a fingerprint that many rows share can be split.
    lookup = materialise(labelled.join(smallest, "root").select("fp", "root", "component_id"), "lookup")
    return prints.join(lookup, "fp").select(*columns, "fp", "root", "component_id")


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE_WORDS, budget: int = MAX_BITS) -> DataFrame:
    """One row of each component of `docs`, all columns as they are.

    The row with the component's smallest doc_id stays; among rows that share it,
    the one whose text has the smallest content key, and one of rows equal in both.
    A component without any doc_id keeps one row likewise.
    """
    keyed = docs.withColumn("__key", row_key())
    found = materialise(
        near_duplicates(keyed, ["doc_id", "__key"], "doc_id", "text", shingle, budget), "found"
    )
    # One row of each component: the smallest id first, nulls last, then the content key.
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("__key").alias("__key"))
    best = materialise(found.groupBy("root").agg(F.min(rank).alias("best")), "best")
    stays = best.select(F.col("best.doc_id").alias("doc_id"), F.col("best.__key").alias("__key"))
    keys = materialise(found.groupBy("doc_id", "__key").count(), "keys")
    kept = keys.join(
        stays.withColumnsRenamed({"doc_id": "d", "__key": "k"}),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("__key") == F.col("k")),
        "left",
    )
    kept = materialise(kept, "kept")
    gone = kept.where("k is null or count > 1")
    # Rows that repeat entirely: one of each comes back.
    repeated = kept.where("k is not null and count > 1").select(
        F.col("doc_id").alias("d"), F.col("__key").alias("k")
    )
    again = keyed.join(
        repeated, keyed.doc_id.eqNullSafe(F.col("d")) & (keyed["__key"] == F.col("k")), "left_semi"
    ).dropDuplicates(["doc_id", "__key"])
    return without(keyed, gone, ["doc_id", "__key"]).unionByName(again).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
