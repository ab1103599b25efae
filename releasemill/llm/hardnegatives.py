"""Hard negatives by the method of the four Russians.

Candidates' integer components are cut into bit planes, each plane's bits packed into a
byte for every eight dimensions.  For an anchor, a table of 256 sums answers each
group of eight: the sum of its components where the byte has bits.  A score is then
lookups, shifts and additions: each plane's lookups are added, shifted by the plane's
place and added up; the sign plane counts negative.  The scores are the whole inner
products, exact.

Anchors come in blocks, candidates in chunks, and every block meets every chunk once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from releasemill.llm.frames import slices
from releasemill.llm.whitening import usable
from releasemill.workspace import materialise

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LEAST, MOST = 30, 90  # per cent of the positive's score

GROUP = 8
# Bytes of anchors' tables that a task holds, the most anchors in it, and rows that it
# scores at once.
TABLE_BYTES = 64 << 20
ANCHORS_PER_BLOCK = 2048
ROWS_AT_ONCE = 512
# Rows of a chunk; small inputs get smaller chunks, so that all cores have work.
CHUNK_ROWS = 65_536
FEWEST_ROWS = 1024
# A score with the row's place behind it must fit 64 bits.
SCORE_BITS = 52
_NONE = np.iinfo(np.int64).min


# --- scores --------------------------------------------------------------------------


def planes_needed(largest: int) -> int:
    """Bits that hold whole numbers from -largest to largest, sign included."""
    return int(largest).bit_length() + 1


def packed(components: np.ndarray, planes: int) -> np.ndarray:
    """`rows x planes x groups` bytes: the bit planes of whole numbers in two's complement."""
    rows, dims = components.shape
    bits = (components[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").reshape(rows, planes, -(-dims // GROUP))


def tables(anchors: np.ndarray, largest: int) -> np.ndarray:
    """`groups x 256 x anchors` sums: of the components of a group where a byte has bits."""
    count, dims = anchors.shape
    groups = -(-dims // GROUP)
    kind = np.int32 if max(1, dims) * largest < 1 << 31 else np.int64
    padded = np.zeros((count, groups * GROUP), dtype=np.int64)
    padded[:, :dims] = anchors
    out = np.zeros((groups, 256, count), dtype=kind)
    for group in range(groups):
        for bit in range(GROUP):
            own = padded[:, group * GROUP + bit].astype(kind)
            # Bytes with this bit as their highest: those below it, and the component.
            out[group, 1 << bit : 2 << bit] = out[group, : 1 << bit] + own
    return out


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """`anchors x rows` inner products from the anchors' tables and the rows' packed planes."""
    rows, count, groups = planes.shape
    total = np.zeros((rows, sums.shape[2]), dtype=np.int64)
    found = np.empty((rows, sums.shape[2]), dtype=sums.dtype)
    for plane in range(count):
        level = np.zeros_like(found)
        for group in range(groups):
            np.take(sums[group], planes[:, plane, group], axis=0, out=found)
            level += found
        weighted = level.astype(np.int64) << plane
        total += -weighted if plane == count - 1 else weighted
    return np.ascontiguousarray(total.T)


class Best:
    """The first rows of each line of a score matrix, gathered over blocks of rows.

    Rows come in rising order, so of equal scores the earlier row is first.
    """

    def __init__(self, lines: int, count: int):
        self.count = count
        self.score = np.full((lines, 0), _NONE, dtype=np.int64)
        self.row = np.zeros((lines, 0), dtype=np.int64)

    def add(self, matrix: np.ndarray, allowed: np.ndarray, first: int) -> None:
        rows = matrix.shape[1]
        place = ROWS_AT_ONCE - 1 - np.arange(rows)
        key = np.where(allowed, matrix * ROWS_AT_ONCE + place, _NONE)
        keep = min(self.count, rows)
        top = np.partition(key, rows - keep, axis=1)[:, rows - keep :]
        real = top != _NONE
        score = np.where(real, top >> (ROWS_AT_ONCE.bit_length() - 1), _NONE)
        row = first + ROWS_AT_ONCE - 1 - (top & (ROWS_AT_ONCE - 1))
        self.score = np.hstack([self.score, score])
        self.row = np.hstack([self.row, row])
        order = np.lexsort((self.row, -self.score.astype(np.float64)), axis=1)[:, : self.count]
        self.score = np.take_along_axis(self.score, order, axis=1)
        self.row = np.take_along_axis(self.row, order, axis=1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Line, row and score of what was found."""
        line, at = np.nonzero(self.score != _NONE)
        return line, self.row[line, at], self.score[line, at]


# --- in Spark ------------------------------------------------------------------------


def anchors_per_block(dims: int) -> int:
    """Anchors whose tables, 256 longs for each group of dimensions, stay in bounds."""
    groups = max(1, -(-dims // GROUP))
    return max(1, min(ANCHORS_PER_BLOCK, TABLE_BYTES // (groups * 256 * 8)))


def prepared(embeddings: DataFrame, label: Column, id_column: str, vector: str) -> tuple[DataFrame, int, int, int]:
    """Written rows `row, id, label, size, planes, components`, their number, the largest component, the longest vector.

    `components` is kept for anchors alone.
    """
    whole = F.transform(F.col(f"`{vector}`"), lambda c: F.floor(c.cast("double") * SCALE))
    rows = embeddings.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), label.cast("long").alias("label"),
        F.when(usable_or_empty(vector), whole).alias("x"),
    ).where(F.col("label").isNotNull() & F.col("x").isNotNull())
    sizes = rows.agg(
        F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))).alias("largest"),
        F.max(F.size("x")).alias("dims"), F.count("*").alias("n"),
    ).first()
    largest, dims = sizes["largest"] or 0, sizes["dims"] or 0
    if largest**2 * dims >= 1 << SCORE_BITS:
        raise ValueError(f"components of up to {largest / SCALE:g} give scores above 2^{SCORE_BITS}")
    count = planes_needed(largest)

    def run(batches):
        for batch in slices(batches, 4096):
            size = batch.column("size").to_numpy()
            out: list = [None] * batch.num_rows
            for dim in np.unique(size).tolist():
                place = np.flatnonzero(size == dim)
                if dim:
                    own = batch.column("x").take(pa.array(place)).flatten().to_numpy(zero_copy_only=False)
                    made = packed(own.reshape(len(place), dim), count)
                else:
                    made = np.zeros((len(place), 0), dtype=np.uint8)
                for k, line in zip(place.tolist(), made.reshape(len(place), -1)):
                    out[k] = line.tobytes()
            names = ["row", "id", "label", "size"]
            anchor = np.array([i is not None and i % 100 == 0 for i in batch.column("id").to_pylist()], dtype=bool)
            lines = batch.column("x")
            kept = [lines[k].as_py() if own else None for k, own in enumerate(anchor.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(out, pa.binary()), pa.array(kept, pa.list_(pa.int64()))],
                names=[*names, "planes", "components"],
            )

    # The table is written, so these numbers name its rows from then on.
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", F.size("x").alias("size"), "x")
    schema = "row long, id long, label long, size int, planes binary, components array<long>"
    return materialise(numbered.mapInArrow(run, schema), "packed"), sizes["n"], largest, dims


def usable_or_empty(vector: str) -> Column:
    return usable(vector) | F.coalesce(F.size(F.col(f"`{vector}`")) == 0, F.lit(False))


def _blocks(batches):
    """(pair of block and chunk, kind, batch) in the order of the rows."""
    for batch in batches:
        key = np.stack([batch.column(c).to_numpy() for c in ("size", "block", "chunk", "kind")], axis=1)
        edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield tuple(key[a, :3].tolist()), int(key[a, 3]), batch.slice(a, b - a)


def _met(rows: DataFrame, anchors: DataFrame, blocks: int, total: int) -> DataFrame:
    """Each block of anchors (kind 0) and each chunk of rows (kind 1) side by side, in order.

    `anchors` has a column `bands` beside those of `rows`.  Rows are written once for
    each block, anchors once for each chunk.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    chunks = max(1, math.ceil(total / CHUNK_ROWS), min(2 * cores, math.ceil(total / FEWEST_ROWS)))

    def part(parts):
        return F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")

    def every(parts):
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    asking = anchors.select(
        "size", part(blocks).alias("block"), every(chunks).alias("chunk"), F.lit(0).alias("kind"), "id",
        "row", "label", F.lit(None).cast("binary").alias("planes"), "components", "bands",
    )
    asked = rows.select(
        "size", every(blocks).alias("block"), part(chunks).alias("chunk"), F.lit(1).alias("kind"), "id",
        "row", "label", "planes", F.lit(None).cast("array<long>").alias("components"),
        F.lit(None).cast("array<struct<id:long,score:long>>").alias("bands"),
    )
    key = ["size", "block", "chunk"]
    return (
        asking.unionByName(asked).repartition(blocks * chunks, *key)
        .sortWithinPartitions(*key, "kind", F.col("id").asc_nulls_last(), "row")
    )


def _searched(met: DataFrame, largest: int, schema: str, opened, found) -> DataFrame:
    """Score every chunk against its block.

    `opened(anchors)` makes what a block looks for, with `add(matrix, labels, rows, first)`;
    `found(block, ids)` is its result for the chunk, the rows' ids at hand.
    """

    def run(batches):
        current, parts, state, ids, first = None, [], None, [], 0
        waiting = []

        def score():
            nonlocal first, waiting
            batch = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting = []
            dims = current[0]
            planes = np.frombuffer(b"".join(batch.column("planes").to_pylist()), dtype=np.uint8)
            count = planes_needed(largest)
            planes = planes.reshape(batch.num_rows, count, -(-dims // GROUP))
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                own = batch.slice(a, ROWS_AT_ONCE)
                matrix = scores(state[0], planes[a : a + ROWS_AT_ONCE])
                state[1].add(matrix, own.column("label").to_numpy(), own.column("row").to_numpy(), first + a)
            first += batch.num_rows

        def closed():
            if state is not None:
                if waiting:
                    score()
                yield from found(state[1], ids)

        for group, kind, batch in _blocks(batches):
            if group != current:
                yield from closed()
                current, parts, state, ids, first = group, [], None, [], 0
            if kind == 0:
                parts.append(batch)
                continue
            if state is None:
                if not parts:
                    continue  # no anchor of this length in the block
                block = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                values = block.column("components").flatten().to_numpy(zero_copy_only=False)
                values = values.reshape(block.num_rows, current[0])
                state, parts = (tables(values, largest), opened(block)), []
            ids += batch.column("id").to_pylist()
            waiting.append(batch.select(["row", "label", "planes"]))
            if sum(b.num_rows for b in waiting) >= 4 * ROWS_AT_ONCE:
                # Whole blocks only, so that places stay those of the chunk.
                score()
        yield from closed()

    return met.mapInArrow(run, schema)


class _Positives:
    def __init__(self, block: pa.RecordBatch, count: int):
        self.label = block.column("label").to_numpy()
        self.row = block.column("row").to_numpy()
        self.best = Best(block.num_rows, count)

    def add(self, matrix, labels, rows, first):
        allowed = (self.label[:, None] == labels[None, :]) & (self.row[:, None] != rows[None, :])
        self.best.add(matrix, allowed, first)


class _Negatives:
    def __init__(self, block: pa.RecordBatch, count: int):
        self.label = block.column("label").to_numpy()
        self.row = block.column("row").to_numpy()
        self.bands = block.column("bands").to_pylist()
        self.best = []
        for place in range(max((len(b) for b in self.bands), default=0)):
            lines = np.array([k for k, b in enumerate(self.bands) if len(b) > place])
            score = [self.bands[k][place]["score"] for k in lines.tolist()]
            # Whole-number bounds of least * score <= 100 * s <= most * score.
            low = np.array([-(-LEAST * s // 100) for s in score], dtype=np.int64)
            high = np.array([MOST * s // 100 for s in score], dtype=np.int64)
            self.best.append((lines, low, high, Best(len(lines), count)))

    def add(self, matrix, labels, rows, first):
        other = self.label[:, None] != labels[None, :]
        for lines, low, high, best in self.best:
            own = matrix[lines]
            allowed = other[lines] & (own >= low[:, None]) & (own <= high[:, None])
            best.add(own, allowed, first)


def mined(embeddings: DataFrame, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
          id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    Rows without `label`, and vectors that are null or hold null or non-finite
    components, take no part.  Every other row is a row of its own, also where it
    repeats an id or a vector; one without id is no anchor and comes last of equal
    scores.  Vectors of different lengths never meet; empty ones score 0.  A positive
    with a negative score has no negatives, one of score 0 those of score 0.
    """
    rows, total, largest, dims = prepared(embeddings, label, id_column, vector)
    anchors = rows.where(F.col("components").isNotNull())
    blocks = max(1, math.ceil(anchors.count() / anchors_per_block(dims)))
    none = F.lit(None).cast("array<struct<id:long,score:long>>")

    def near(best, ids):
        line, row, score = best.best.rows()
        own = pa.array(ids, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.row[line], pa.int64()), own.take(pa.array(row)), pa.array(score, pa.int64())],
            names=["anchor", "id", "score"],
        )

    def hard(best, ids):
        own = pa.array(ids, pa.int64())
        for place, (lines, _, _, found) in enumerate(best.best):
            line, row, score = found.rows()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(best.row[lines[line]], pa.int64()),
                    pa.array(np.full(len(line), place), pa.int32()),
                    own.take(pa.array(row)), pa.array(score, pa.int64()),
                ],
                names=["anchor", "place", "id", "score"],
            )

    met = _met(rows, anchors.withColumn("bands", none), blocks, total)
    near_rows = _searched(
        met, largest, "anchor long, id long, score long", lambda block: _Positives(block, positives), near
    )
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    first = Window.partitionBy("anchor").orderBy(*order)
    chosen = (
        near_rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
        .groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("found"))
        .select("anchor", F.transform("found", lambda f: F.struct(f["id"].alias("id"), f["score"].alias("score"))).alias("bands"))
    )
    # As many rows as anchors, each with a handful of positives.
    asking = materialise(
        anchors.join(chosen, anchors["row"] == chosen["anchor"]).drop("anchor"), "anchors"
    )
    hard_rows = _searched(
        _met(rows, asking, blocks, total), largest, "anchor long, place int, id long, score long",
        lambda block: _Negatives(block, negatives), hard,
    )
    first = Window.partitionBy("anchor", "place").orderBy(*order)
    ranked = hard_rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    named = asking.select(F.col("row").alias("of"), F.col("id").alias("anchor_id"), "bands")
    band = F.col("bands")[F.col("place")]
    return ranked.join(named, F.col("anchor") == F.col("of")).select(
        "anchor_id", band["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), band["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
