"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

# Rows that a task takes from an Arrow batch at once; texts may be long.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str) -> Column:
    """The text as bytes; null stays null."""
    return F.col(column).cast("string").cast("binary")


def row_key(text: str = "text") -> Column:
    """Content key: with the id it names a row, however often the plan is run."""
    return F.xxhash64(F.col(text).cast("string"), F.length(F.col(text).cast("string")))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in smaller pieces, so that Python objects of few rows live at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def nullable(schema: StructType) -> StructType:
    out = StructType()
    for field in schema:
        out = out.add(field.name, field.dataType, True)
    return out


def extended(
    frame: DataFrame,
    source: str,
    fields: list[tuple[str, str | DataType, pa.DataType]],
    make: Callable[[], Callable[[list], list[list]]],
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """`frame` without column `source`, plus columns that `make()` computes from it.

    `make` is called once in each task and returns a function from the values of
    `source` to one list for each of `fields` (name, Spark type, Arrow type).  Like
    `withColumn`, a new column replaces one of its name.
    """
    new = {name for name, _, _ in fields}
    kept = [c for c in frame.columns if c != source and c not in new]
    types = [kind for _, _, kind in fields]
    names = [*kept, *[name for name, _, _ in fields]]

    def run(batches):
        compute = None
        for batch in slices(batches, rows):
            compute = compute or make()
            made = compute(batch.column(source).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    *[pa.array(values, kind) for values, kind in zip(made, types)],
                ],
                names=names,
            )

    schema = frame.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name, kind, _ in fields:
        schema = schema.add(name, kind)
    return frame.mapInArrow(run, schema)


def without(frame: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """`frame` without the rows whose keys are in `gone`; null keys are compared as values.

    The counted size of `gone` decides whether it is broadcast.
    """
    from releasemill.workspace import materialise, small_side

    gone = materialise(gone.select(*keys).distinct(), "gone")
    side = small_side(gone.withColumnsRenamed({k: f"__gone_{k}" for k in keys}), gone.count())
    match = [frame[k].eqNullSafe(side[f"__gone_{k}"]) for k in keys]
    return frame.join(side, match, "left_anti")
