"""Record frames: widening, renaming, lineage, target shape, order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from releasemill.model import (
    LAYOUT_SEP,
    LINEAGE,
    RECORD_KEY,
    RENAMES,
    TARGET_SCHEMA,
)
from releasemill.workspace import materialise, small_side

# Above this many distinct fields a plan with one column each is not workable: fields
# seen later share one map column.
MAX_FIELDS = 10_000
OTHER_FIELDS = "other_fields"
CASE_SENSITIVE = "spark.sql.caseSensitive"
SORT_TASK_BYTES = 128 << 20


def good_records(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("error").isNull()).drop("error", "fatal")


def field_order(records: DataFrame) -> list[str]:
    """The first MAX_FIELDS field names and one more, in order of first appearance.

    Fields that the records keep as columns are among them wherever they appear first.
    Records of one layout collapse map-side, so only a row per distinct layout
    is shuffled; of the bronze table just `layout` and the ordinals are read.
    """
    first = F.min(F.struct(*LINEAGE)).alias("first")
    layouts = records.groupBy("layout").agg(first)
    names = (
        layouts.select(
            "first",
            F.posexplode(F.split("layout", LAYOUT_SEP)).alias("pos", "name"),
        )
        .filter(F.col("name") != "")
        .groupBy("name")
        .agg(F.min(F.struct("first", "pos")).alias("seen"))
    )
    first = names.orderBy("seen").limit(MAX_FIELDS + 1)
    known = _field_columns(records)
    if known:
        first = first.union(names.where(F.col("name").isin(*known))).distinct()
    return [row["name"] for row in sorted(first.collect(), key=lambda row: row["seen"])]


def _field_columns(records: DataFrame) -> set[str]:
    return set(records.columns) - {"fields", *LINEAGE, "parent", "entry", "layout"}


def field_column(records: DataFrame, name: str) -> Column:
    """A field, wherever the bronze table keeps it."""
    if name in _field_columns(records):
        return F.col(f"`{name}`")
    return F.col("fields")[F.lit(name)]


def widen(records: DataFrame, fields: list[str] | None = None, keep=LINEAGE) -> DataFrame:
    """One string column per field; a missing field is NULL, a blank one empty.

    Lineage columns come along under a `_` prefix, so no field can clash.  Fields
    above MAX_FIELDS, unless the records keep them as columns, and those that differ from an earlier one in case only where
    the session ignores case, are kept in one more column, the map `other_fields`.
    """
    found = field_order(records) if fields is None else list(fields)
    fold = str if records.sparkSession.conf.get(CASE_SENSITIVE) == "true" else str.lower
    shown = found
    if fields is None:
        known = _field_columns(records)
        shown = [name for place, name in enumerate(found) if place < MAX_FIELDS or name in known]
    names = {fold(name): name for name in reversed(shown)}
    names = [name for name in shown if names.get(fold(name)) == name]
    surplus = []
    if fields is None and len(names) < len(found):
        other = F.map_filter("fields", lambda name, _: ~name.isin(*names))
        # Known fields have columns of their own; one may come after a name like it.
        lost = [n for n in found if n not in names and n in _field_columns(records)]
        more = F.create_map(*[x for n in lost for x in (F.lit(n), F.col(f"`{n}`"))]) if lost else None
        if lost:
            other = F.map_concat(other, F.map_filter(more, lambda _, value: value.isNotNull()))
        taken = fold(OTHER_FIELDS) in {fold(name) for name in names}
        surplus = [other.alias(f"_{OTHER_FIELDS}" if taken else OTHER_FIELDS)]
    return records.select(
        *[F.col(c).alias(f"_{c}") for c in keep],
        *[field_column(records, name).alias(name) for name in names],
        *surplus,
    )


def drop_lineage(frame: DataFrame) -> DataFrame:
    return frame.drop(*[f"_{c}" for c in (*LINEAGE, "parent", "entry")])


def record_order(frame: DataFrame, key: str = RECORD_KEY) -> list[Column]:
    """Key ascending with missing keys last, then place of origin.

    The origin makes the order total, and lets a range sort split a key that
    many records share.
    """
    order = [F.col(f"_{c}").asc() for c in LINEAGE if f"_{c}" in frame.columns]
    return [F.col(f"`{key}`").asc_nulls_last(), *order]


def range_sort(frame: DataFrame, order: list[Column], size_bytes: int = 0) -> DataFrame:
    """Global order.

    `size_bytes` is the volume being sorted: large inputs get as many range
    partitions as they need rather than the session default.
    """
    tasks = math.ceil(size_bytes / SORT_TASK_BYTES)
    if tasks <= int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return frame.orderBy(*order)
    return frame.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def sort_records(frame: DataFrame, size_bytes: int = 0, key: str = RECORD_KEY) -> DataFrame:
    """Order by record key; a frame without the key stays as it is."""
    if key not in frame.columns:
        return frame
    return range_sort(frame, record_order(frame, key), size_bytes)


def with_position(frame: DataFrame, order: list[Column], name: str,
                  size_bytes: int = 0) -> DataFrame:
    """Number the rows 1..n in a total order, without passing them through one task.

    The sorted rows are written with their partition and place in it; the row
    counts of the partitions (as many rows as there are partitions) give the
    offsets.
    """
    placed = materialise(
        range_sort(frame, order, size_bytes).select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
        ),
        "sorted",
    )
    # One row for each partition, so the only window over all of them is small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("rows")).select(
        "_part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(small_side(offsets, offsets.count()), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .drop("_part", "_place", "_offset")
    )


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Outer union of columns in first-seen order; duplicates stay."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def rename_columns(frame: DataFrame) -> DataFrame:
    """Source field names to target names; other columns pass through."""
    return frame.withColumnsRenamed(RENAMES)


def add_lineage(frame: DataFrame, *, data_date, now, kind: str, zip_file="") -> DataFrame:
    """The five metadata columns of the target table.

    `data_date` and `zip_file` are text or columns; `now` is a datetime or column.
    `archive_name()` as `zip_file` names each record's archive, if the frame kept
    its lineage.
    """

    def column(value):
        return value if isinstance(value, Column) else F.lit(value)

    return frame.withColumns(
        {
            "data_date": column(data_date),
            "data_zip_file": column(zip_file),
            "download_time": column(now),
            "source_file": F.lit(f"{kind}_merged"),
            "source_type": F.lit(kind),
        }
    )


def archive_name() -> Column:
    return F.element_at(F.split("_archive", "/"), -1)


def unmapped_columns(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c not in TARGET_SCHEMA.names and not c.startswith("_")]


def target_projection(frame: DataFrame, on_unmapped: str = "drop") -> DataFrame:
    """The declared target row; absent columns are NULL."""
    extra = unmapped_columns(frame)
    if extra and on_unmapped == "fail":
        raise ValueError(f"columns without a place in the target table: {extra}")
    present = set(frame.columns)
    return frame.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TARGET_SCHEMA
        ]
    )


def nan_to_null(frame: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL; text stays as it is."""
    return frame.withColumns(
        {
            name: F.nanvl(F.col(f"`{name}`"), F.lit(None).cast(kind))
            for name, kind in frame.dtypes
            if kind in ("double", "float")
        }
    )


def with_create_time(frame: DataFrame, now) -> DataFrame:
    """Insertion time, which the Oracle and MySQL tables fill by default."""
    return frame.withColumn("create_time", now if isinstance(now, Column) else F.lit(now))
