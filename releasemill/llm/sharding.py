"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from releasemill.workspace import materialise, small_side

# Rows of a range partition in which slots are numbered.
ROWS_PER_TASK = 2_000_000
_PLACE_MASK = (1 << 33) - 1


def weight_score(key: Column, shard: str, weight: float) -> Column:
    """Rendezvous score of a shard for a key: -weight / ln(u), u in (0, 1) from both names.

    A shard gets a share of the keys in proportion to its weight.
    """
    hashed = F.shiftrightunsigned(F.xxhash64(F.concat(key, F.lit(f":{shard}"))), 11)
    return F.lit(-float(weight)) / F.ln((hashed.cast("double") + 0.5) / F.lit(float(1 << 53)))


def choose(key: Column, weights: list[float]) -> Column:
    """Number of the shard with the highest score; the lower number wins a tie.

    `key` is text; null counts as the empty key.  A further shard changes no other
    shard's score, so it takes rows only into itself.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    named = F.coalesce(key.cast("string"), F.lit(""))
    scores = F.array(*[weight_score(named, str(k), w) for k, w in enumerate(weights)])
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def with_slots(frame: DataFrame, shard: str, order: list[str], name: str = "slot") -> DataFrame:
    """Number the rows of each shard 0, 1, ... by `order` without gathering a shard in a task.

    Rows are range-partitioned by shard and order, with a tiebreak that lets rows
    equal in `order` be split; each partition's place and row counts per shard
    give the numbers.  Equal rows get neighbouring numbers in any order.
    """
    rows = materialise(frame.withColumn("__tie", F.monotonically_increasing_id()), "rows")
    session = frame.sparkSession
    tasks = max(
        int(session.conf.get("spark.sql.shuffle.partitions")),
        math.ceil(rows.count() / ROWS_PER_TASK),
    )
    columns = [F.col(c).asc_nulls_first() for c in [shard, *order, "__tie"]]
    placed = materialise(
        rows.repartitionByRange(tasks, *columns)
        .sortWithinPartitions(*columns)
        .select(
            "*",
            F.spark_partition_id().alias("__part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_MASK)).alias("__place"),
        ),
        "placed",
    )
    # A row for each partition and shard in it: about as many as there are partitions.
    pieces = placed.groupBy("__part", shard).agg(
        F.count("*").alias("__rows"), F.min("__place").alias("__from")
    )
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = materialise(
        pieces.select(
            "__part", shard,
            (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__from")).alias("__shift"),
        ),
        "shifts",
    )
    return (
        placed.join(small_side(shifts, shifts.count()), ["__part", shard])
        .withColumn(name, F.col("__place") + F.col("__shift"))
        .drop("__part", "__place", "__shift", "__tie")
    )


def shards(docs: DataFrame, weights: list[float], grown: float | None = None,
           id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's id, size, text checksum, shard, slot and its shard with one more shard.

    size is the text's UTF-8 bytes (null: none) plus 1; text_crc32 that of its
    bytes, 0 for null or empty.  Rows of one id share a shard, a null id counts as
    the empty key.  slot numbers the rows of a shard from 0 without gaps, by id,
    checksum and size.  grown is the weight of the further shard (default: the mean).
    """
    raw = F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b""))
    key = F.col(f"`{id_column}`")
    more = [*weights, grown or sum(weights) / len(weights)]
    base = docs.select(
        key.alias(id_column),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"),
        choose(key, weights).alias("shard"),
        choose(key, more).alias("grown_shard"),
    )
    return with_slots(base, "shard", [id_column, "text_crc32", "size"])
