"""Embedding near-duplicates with hierarchical navigable small-world graphs per shard.

Equal vectors are one class.  Classes are dealt to shards; a task builds the graph of
a shard and searches it with the vectors of the shards it has to meet, so that every
pair of shards meets once.  Probes near shard vectors audit the search against a full
scan, each probe by itself: the beam widens until enough is found, and a shard whose
audit never passes is scanned.  A query whose beam is full of links is scanned as well, so large groups lose
nothing.  Links are verified in double precision; tasks emit link counts and forests
of links, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from releasemill.llm.components import components
from releasemill.llm.simhash import Forest
from releasemill.workspace import materialise

COSINE = 0.95
SHARDS = 8
# Classes of a shard at most, about; more classes get more shards.
SHARD_ROWS = 500_000

NEIGHBOURS = 12  # links of a node in upper layers; twice as many in the lowest
BUILD_BEAM = 48
BEAM, WIDEST_BEAM = 16, 256
FIRST_NODES = 256  # nodes of the top layer at most
LAYER_RATIO = 16
BATCH = 512
EXPANDED = 4  # nodes whose neighbours a step of the search reads

# Audit: probes of a shard, their cosine to the vector they stand for, share to be found.
PROBES = 128
DRAWS = 16  # times that probes are drawn at most, as long as too few are left to the beam
PROBE_COSINE = 0.955
AUDIT_RECALL = 0.98
# Rows of a full scan at once.
SCAN_ROWS = 1 << 15
SLACK = 1e-4  # of single against double precision


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _cosines(vectors: np.ndarray, queries: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Cosine of each query with its chosen rows; -inf where the row is -1."""
    near = np.matmul(vectors[chosen], queries[:, :, None])[:, :, 0]
    return np.where(chosen >= 0, near, -np.inf)


def _merged(ids, near, done, more, more_near, width: int):
    """The best `width` of two candidate lists of each row, without repetitions."""
    ids = np.concatenate([ids, more], axis=1)
    near = np.concatenate([near, more_near], axis=1)
    done = np.concatenate([done, np.zeros(more.shape, dtype=bool)], axis=1)
    order = np.argsort(ids, axis=1, kind="stable")  # earlier ones, with their mark, come first
    ids, near, done = (np.take_along_axis(x, order, axis=1) for x in (ids, near, done))
    near[:, 1:][ids[:, 1:] == ids[:, :-1]] = -np.inf
    if ids.shape[1] > width:
        best = np.argpartition(-near, width - 1, axis=1)[:, :width]
        ids, near, done = (np.take_along_axis(x, best, axis=1) for x in (ids, near, done))
    ids = np.where(np.isfinite(near), ids, -1)
    return ids, near, done | (ids < 0)


class Graph:
    """Layers of a small-world graph; layer k holds the first `sizes[k]` rows.

    Rows come in random order, so a prefix is a random subset.  A layer starts as a
    copy of the one above and takes in its further rows in batches.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        sizes = [len(vectors)]
        while sizes[-1] > FIRST_NODES:
            sizes.append(max(1, sizes[-1] // LAYER_RATIO))
        self.sizes = sizes
        self.layers: list[np.ndarray] = [None] * len(sizes)
        for level in range(len(sizes) - 1, -1, -1):
            self._build(level)

    def _build(self, level: int) -> None:
        width = NEIGHBOURS * (1 if level else 2)
        size, top = self.sizes[level], level == len(self.sizes) - 1
        links = np.full((size, width), -1, dtype=np.int64)
        self.layers[level] = links
        if top:
            rows = np.arange(size)
            near = self.vectors[:size] @ self.vectors[:size].T
            np.fill_diagonal(near, -np.inf)
            count = min(size - 1, BUILD_BEAM)
            if count > 0:
                best = np.argpartition(-near, count - 1, axis=1)[:, :count]
                links[:] = self._diverse(rows, best, np.take_along_axis(near, best, axis=1), width)
                self._backward(links, rows, links.copy())
            return
        above = self.layers[level + 1]
        links[: len(above), : above.shape[1]] = above
        for start in range(len(above), size, BATCH):
            rows = np.arange(start, min(start + BATCH, size))
            queries = self.vectors[rows]
            ids, near = self._beam(links, queries, self._enter(queries, level), BUILD_BEAM)
            inside = queries @ queries.T  # rows of the batch may link to each other
            np.fill_diagonal(inside, -np.inf)
            count = min(len(rows) - 1, NEIGHBOURS)
            if count > 0:
                best = np.argpartition(-inside, count - 1, axis=1)[:, :count]
                ids = np.concatenate([ids, rows[best]], axis=1)
                near = np.concatenate([near, np.take_along_axis(inside, best, axis=1)], axis=1)
            links[rows] = self._diverse(rows, ids, near, width)
            self._backward(links, rows, links[rows])

    def _diverse(self, rows, ids, near, width: int) -> np.ndarray:
        """Neighbours that are closer to their row than to any chosen before them."""
        order = np.argsort(-near, axis=1)
        ids, near = np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)
        ids = np.where(np.isfinite(near), ids, -1)
        own = self.vectors[ids]
        between = np.matmul(own, own.transpose(0, 2, 1))
        count = ids.shape[1]
        chosen = np.zeros(ids.shape, dtype=bool)
        closest = np.full(ids.shape, -np.inf, dtype=near.dtype)
        for k in range(count):
            take = (ids[:, k] >= 0) & (near[:, k] > closest[:, k]) & (chosen.sum(axis=1) < width)
            chosen[:, k] = take
            closest = np.where(take[:, None], np.maximum(closest, between[:, k]), closest)
        # Free places take the nearest of the rest.
        rank = np.where(ids < 0, 2 * count, np.where(chosen, 0, count) + np.arange(count))
        keep = np.argsort(rank, axis=1, kind="stable")[:, :width]
        out = np.full((len(rows), width), -1, dtype=np.int64)
        out[:, : keep.shape[1]] = np.take_along_axis(ids, keep, axis=1)
        return out

    def _backward(self, links, rows, chosen) -> None:
        """Link the chosen neighbours back to their rows, keeping diverse ones."""
        source = np.repeat(rows, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        width = links.shape[1]
        for start in range(0, int(count.max(initial=0)), width):  # some get many at once
            some = count > start
            own, at = nodes[some], first[some] + start
            place = at[:, None] + np.arange(width)
            new = np.where(
                np.arange(width) < (count[some] - start)[:, None],
                source[np.minimum(place, len(source) - 1)], -1,
            )
            for part in range(0, len(own), BATCH):
                node, more = own[part : part + BATCH], new[part : part + BATCH]
                held = links[node]
                queries = self.vectors[node]
                ids, near, _ = _merged(
                    held, _cosines(self.vectors, queries, held), np.zeros(held.shape, dtype=bool),
                    more, _cosines(self.vectors, queries, more), 2 * width,
                )
                links[node] = self._diverse(node, ids, near, width)

    def _enter(self, queries: np.ndarray, level: int) -> np.ndarray:
        """Nodes near each query, found on the layers above `level`."""
        top = len(self.sizes) - 1
        near = queries @ self.vectors[: self.sizes[top]].T
        count = min(4, near.shape[1])
        entry = np.argpartition(-near, count - 1, axis=1)[:, :count]
        for layer in range(top - 1, level, -1):
            entry = self._beam(self.layers[layer], queries, entry, 8)[0][:, :4]
        return entry

    def _beam(self, links, queries, entry, width: int):
        """The best `width` nodes that a best-first search from `entry` meets."""
        count = len(queries)
        start = np.where(entry >= 0, entry, -1)
        ids, near, done = _merged(
            start, _cosines(self.vectors, queries, start), np.zeros(start.shape, dtype=bool),
            np.full((count, 1), -1), np.full((count, 1), -np.inf), width,
        )
        if ids.shape[1] < width:
            pad = width - ids.shape[1]
            ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
            near = np.pad(near, ((0, 0), (0, pad)), constant_values=-np.inf)
            done = np.pad(done, ((0, 0), (0, pad)), constant_values=True)
        active = np.arange(count)
        while len(active):
            open_near = np.where(done[active], -np.inf, near[active])
            step = min(EXPANDED, width)
            best = np.argpartition(-open_near, step - 1, axis=1)[:, :step]
            some = np.isfinite(np.take_along_axis(open_near, best, axis=1))
            going = some.any(axis=1)
            active, best, some = active[going], best[going], some[going]
            if not len(active):
                break
            node = np.where(some, np.take_along_axis(ids[active], best, axis=1), -1)
            marked = done[active]
            np.put_along_axis(marked, best, True, axis=1)
            more = np.where(node[:, :, None] >= 0, links[node], -1).reshape(len(active), -1)
            more_near = _cosines(self.vectors, queries[active], more)
            # Only what beats the worst may enter: a node that left never comes back, ties included.
            worst = near[active].min(axis=1, keepdims=True)
            more = np.where(more_near > worst, more, -1)
            ids[active], near[active], done[active] = _merged(
                ids[active], near[active], marked,
                more, np.where(more >= 0, more_near, -np.inf), width,
            )
        order = np.argsort(-near, axis=1)
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)

    def search(self, queries: np.ndarray, width: int):
        return self._beam(self.layers[0], queries, self._enter(queries, 0), width)


class Shard:
    """Finds the rows of a shard within a cosine of queries, by an audited graph search."""

    def __init__(self, rows: np.ndarray, cosine: float, seed: int):
        self.cosine = cosine
        self.order = np.random.default_rng(seed).permutation(len(rows))
        self.double = unit(rows)[self.order]
        self.single = self.double.astype(np.float32)
        self.graph = Graph(self.single) if len(rows) > 2 * FIRST_NODES else None
        self.width, self.recall = BEAM, 1.0
        if self.graph is not None:
            self._audit(seed)

    def _audit(self, seed: int) -> None:
        """Widen the beam until probes find what a full scan finds; else give up the graph.

        The recall is the mean of the probes' own.  Probes with a full beam are scanned
        and say nothing about the graph, so further ones are drawn in their place.
        """
        random = np.random.default_rng(seed + 1)
        order = random.permutation(len(self.double))[: DRAWS * PROBES]
        drawn = [
            self._probes(self.double[order[start : start + PROBES]], random)
            for start in range(0, len(order), PROBES)
        ]
        while True:
            shares: list[float] = []
            for probes in drawn:
                query, _, full = self._beamed(probes)
                left = np.flatnonzero(~full)
                wanted = np.bincount(self._scan(probes[left])[0], minlength=len(left))
                found = np.bincount(query, minlength=len(probes))[left]
                shares += (found[wanted > 0] / wanted[wanted > 0]).tolist()
                if len(shares) >= PROBES:
                    break
            self.recall = float(np.mean(shares)) if shares else 1.0
            if self.recall >= AUDIT_RECALL:
                return
            if self.width >= WIDEST_BEAM:
                self.graph = None
                return
            self.width *= 2

    def _probes(self, chosen: np.ndarray, random) -> np.ndarray:
        """A unit vector beside each of the chosen ones."""
        away = random.standard_normal(chosen.shape)
        away -= (away * chosen).sum(axis=1, keepdims=True) * chosen
        aside = max(self.cosine, PROBE_COSINE)
        probes = aside * chosen
        if chosen.shape[1] > 1:
            probes = probes + np.sqrt(1 - aside**2) * unit(away)
        return unit(probes)

    def _verified(self, queries, query, row):
        near = np.einsum("ij,ij->i", queries[query], self.double[row])
        linked = near >= self.cosine
        return query[linked], row[linked]

    def _scan(self, queries: np.ndarray):
        """All links, block by block."""
        found = [(np.empty(0, dtype=np.int64),) * 2]
        single = queries.astype(np.float32)
        for start in range(0, len(self.single), SCAN_ROWS):
            near = single @ self.single[start : start + SCAN_ROWS].T
            query, row = np.nonzero(near >= self.cosine - SLACK)
            found.append(self._verified(queries, query, row + start))
        return tuple(np.concatenate(parts) for parts in zip(*found))

    def _beamed(self, queries: np.ndarray):
        """Links that the beam search meets, and whether each query's beam is full of them."""
        ids, near = self.graph.search(queries.astype(np.float32), self.width)
        close = near >= self.cosine - SLACK
        full = close.all(axis=1)
        query, place = np.nonzero(close & ~full[:, None])
        return *self._verified(queries, query, ids[query, place]), full

    def _walk(self, queries: np.ndarray):
        """Links that the beam search meets; queries with a full beam are scanned."""
        query, row, full = self._beamed(queries)
        found = [(query, row)]
        many = np.flatnonzero(full)
        if len(many):
            query, row = self._scan(queries[many])
            found.append((many[query], row))
        return tuple(np.concatenate(parts) for parts in zip(*found))

    def links(self, queries: np.ndarray):
        """Pairs (query, row of the shard as given) with at least the cosine, for unit rows."""
        found = [(np.empty(0, dtype=np.int64),) * 2]
        for start in range(0, len(queries), BATCH):
            part = queries[start : start + BATCH]
            query, row = self._walk(part) if self.graph is not None else self._scan(part)
            found.append((query + start, self.order[row]))
        return tuple(np.concatenate(parts) for parts in zip(*found))


# --- in Spark --------------------------------------------------------------------------


def usable(vector: str) -> Column:
    """Whether a vector has components, all present and finite, and is not zero."""
    value = F.col(vector)
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(value) > 0) & ~bad & F.exists(value, lambda x: x != 0), F.lit(False))


def _groups(batches, names):
    """Rows of Arrow batches as (dimension, shard, kind, columns), in their order."""
    for batch in batches:
        shard, size, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "size", "kind"))
        change = (shard[1:] != shard[:-1]) | (size[1:] != size[:-1]) | (kind[1:] != kind[:-1])
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False)
            yield (int(size[a]), int(shard[a])), int(kind[a]), {
                "cid": part.column("cid").to_numpy(zero_copy_only=False),
                "n": part.column("n").to_numpy(zero_copy_only=False),
                "own": part.column("own").to_numpy(zero_copy_only=False),
                "vector": vectors.reshape(b - a, int(size[a])).astype(np.float64),
            }


def found_links(classes: DataFrame, cosine: float = COSINE, shards: int = SHARDS) -> DataFrame:
    """`cid, links, a, b`: link counts of classes, and edges that span the links.

    `classes` is `cid, vector, n` (n rows share the vector).  A class meets its own
    shard and those of the following half of the circle of shards, so two shards
    meet once, and inside a shard the lower cid's search counts.
    """
    rows = classes.select(
        "cid", "n", "vector", F.size("vector").alias("size"),
        F.pmod(F.xxhash64("cid"), F.lit(shards)).alias("own"),
    )
    ahead = F.sequence(F.lit(0), F.when(F.lit(shards % 2 == 0) & (F.col("own") >= shards // 2),
                                        F.lit(max(0, shards // 2 - 1))).otherwise(F.lit(shards // 2)))
    asking = rows.select("*", F.explode(ahead).alias("step")).select(
        "cid", "n", "vector", "size", "own",
        F.pmod(F.col("own") + F.col("step"), F.lit(shards)).alias("shard"), F.lit(1).alias("kind"),
    )
    held = rows.withColumns({"shard": F.col("own"), "kind": F.lit(0)})
    key = ["size", "shard"]
    dealt = (
        held.unionByName(asking).repartition(max(2 * shards, 2), *key)
        .sortWithinPartitions(*key, "kind", "cid")
    )
    names = ["cid", "links", "a", "b"]

    def run(batches):
        current, parts, state = None, [], None

        def counted(cids, links):
            some = links > 0
            none = pa.nulls(int(some.sum()), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(cids[some]), pa.array(links[some]), none, none], names=names
            )

        def opened():
            cids = np.concatenate([p["cid"] for p in parts])
            rows = Shard(np.concatenate([p["vector"] for p in parts]), cosine, seed=current[1])
            sizes = np.concatenate([p["n"] for p in parts])
            return rows, cids, sizes, np.zeros(len(cids), dtype=np.int64), Forest(len(cids))

        for group, kind, columns in _groups(batches, names):
            if group != current:
                if state is not None:
                    yield counted(state[1], state[3])
                current, parts, state = group, [], None
            if kind == 0:
                parts.append(columns)
                continue
            if not parts and state is None:
                continue  # nobody lives in this shard
            if state is None:
                state, parts = opened(), []
            shard, cids, sizes, links, forest = state
            asked = columns["cid"]
            query, row = shard.links(unit(columns["vector"]))
            inside = columns["own"][query] == current[1]
            apart = ~inside | (asked[query] < cids[row])
            own = np.bincount(query[apart], sizes[row[apart]], len(asked)).astype(np.int64)
            yield counted(asked, own)
            np.add.at(links, row[apart], columns["n"][query[apart]])
            # Edges: asking classes to their smallest linked row, and rows that become connected.
            linked = asked[query] != cids[row]
            query, row = query[linked], row[linked]
            if not len(query):
                continue
            before = forest.label.copy()
            whole = Forest(len(cids) + len(asked))
            whole.label[: len(cids)] = before
            whole.add(query + len(cids), row)
            forest.label = whole.label[: len(cids)]
            roots = np.flatnonzero(before == np.arange(len(cids)))
            roots = roots[forest.label[roots] != roots]
            ask = np.unique(query)
            a = np.concatenate([cids[roots], asked[ask]])
            b = np.concatenate([cids[forest.label[roots]], cids[whole.label[ask + len(cids)]]])
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(a), pa.array(b)], names=names)
        if state is not None:
            yield counted(state[1], state[3])

    return dealt.mapInArrow(run, "cid long, links long, a long, b long")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, shards: int = SHARDS,
                    id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`id, n_links, component_id, kept` of every row.

    n_links counts the other rows within the cosine, copies included; component_id
    is the smallest id reachable by links.  Vectors that are null, empty or zero, or
    hold null or non-finite components, link with nothing and are their own
    component, as are vectors of different lengths to each other.  A null id has a
    component only through its links and is never kept; rows that repeat an id are
    rows of their own.
    """
    name = F.col(f"`{id_column}`")
    source = embeddings.select(name.alias("__id"), F.col(f"`{vector}`").alias("vector"))
    keyed = source.select(
        "__id", "vector", usable("vector").alias("usable"),
        # Together 128 bits: rows that agree in both hold the same vector.
        F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit("v"), F.col("vector")).alias("h2"),
    )
    classes = materialise(
        keyed.where("usable").groupBy("h1", "h2")
        .agg(F.first("vector").alias("vector"), F.count("*").alias("n"), F.min("__id").alias("first"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    shards = max(shards, -(-classes.count() // SHARD_ROWS))
    found = materialise(found_links(classes.select("cid", "vector", "n"), cosine, shards), "found")
    links = found.where("cid is not null").groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.where("a is not null").select("a", "b"))
    labelled = materialise(
        classes.select("h1", "h2", "cid", "n", "first")
        .join(links, "cid", "left").join(roots, F.col("cid") == F.col("node"), "left")
        .select("h1", "h2", "first", F.coalesce("root", "cid").alias("root"),
                (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")),
        "labelled",
    )
    smallest = materialise(labelled.groupBy("root").agg(F.min("first").alias("component")), "roots")
    # Written, so that the join of a vector that many rows share can be split.
    lookup = materialise(
        labelled.join(smallest, "root").select(
            F.col("h1").alias("k1"), F.col("h2").alias("k2"), "n_links", "component"
        ),
        "lookup",
    )
    rows = keyed.select("__id", "usable", "h1", "h2")
    match = F.col("usable") & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    component = F.when(F.col("k1").isNull(), F.col("__id")).otherwise(F.col("component"))
    return rows.join(lookup, match, "left").select(
        F.col("__id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("__id") == component, F.lit(False)).alias("kept"),
    )
