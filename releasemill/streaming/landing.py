"""A landing folder of archives as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from releasemill.model import KNOWN_FIELDS
from releasemill.operators.layouts import LayoutRegistry
from releasemill.plans.ingest import read_bronze
from releasemill.streaming import source
from releasemill.workspace import exists, qualified

OTHER_FIELDS = "other_fields"
ARCHIVE_SCHEMA = "archive string, length long, modification_time timestamp, ok boolean"


def landing_stream(spark: SparkSession, location: str, log: str, glob: str = "*.zip") -> DataFrame:
    """Archives that are new or changed, as `scan_archives` gives them; nothing of them is read.

    `log` is a folder of the stream's own on shared storage, kept with its checkpoint.
    Files without a byte have not landed yet.
    """
    source.register(spark)
    return (
        spark.readStream.format(source.NAME)
        .option("log", qualified(spark, log)).option("glob", glob)
        .load(qualified(spark, location))
    )


def run_available(stream: DataFrame, write_batch, checkpoint: str) -> None:
    """Process what has landed since the last run, then stop."""
    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _archives(spark: SparkSession, target: str) -> DataFrame:
    """Archives of all batches as they were found, and whether they could be read."""
    schema, path = f"{ARCHIVE_SCHEMA}, batch long", f"{target}_archives"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _registry(spark: SparkSession, target: str) -> LayoutRegistry:
    return LayoutRegistry(spark, f"{target}_layouts")


def _promoted(registry: LayoutRegistry, fields, upto: int | None = None) -> list[str]:
    """Fields besides `fields` that have columns; those named like a column of the table stay in the map."""
    return registry.fields(upto, reserved=(*fields, "batch", OTHER_FIELDS))


def _without(names: list[str]):
    """The map column without the entries that are columns."""
    if not names:
        return F.col(OTHER_FIELDS)
    own = F.array(*map(F.lit, names))
    return F.map_filter(OTHER_FIELDS, lambda name, _: ~F.array_contains(own, name)).alias(OTHER_FIELDS)


def append_records(target: str, fields=KNOWN_FIELDS, promote: bool = False):
    """Batch writer: the records of new archives under `target`, one folder per batch.

    A replayed batch overwrites its own folder, so each archive counts once.
    The folder names carry the batch, which reads back as column `batch`.  Unforeseen
    fields go to one map column; with `promote` they become columns from the batch on that
    first brings them, noted in `<target>_layouts` (see `read_records`).
    `<target>_archives` tells, for every archive as it was found, whether it could
    be read; it is written last.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = _archives(spark, target).filter(f"ok and batch <> {batch_id}").select("archive")
        todo = batch.join(done, "archive", "left_anti")
        bronze = read_bronze(todo, on_bad_archive="skip", columns=fields)
        records = bronze.records
        known = records.select(*fields, F.col("fields").alias(OTHER_FIELDS))
        if promote:
            registry = _registry(spark, target)
            registry.note(batch_id, records)
            more = _promoted(registry, fields, batch_id)
            known = known.select(
                *fields, *[F.col(OTHER_FIELDS)[F.lit(n)].alias(n) for n in more], _without(more)
            )
        known.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        bronze.dead_letter.write.mode("overwrite").parquet(
            f"{target}_failures/batch={batch_id}"
        )
        found = todo.select("archive", "length", "modification_time")
        bad = bronze.bad_archives
        if bad is None:
            state = found.withColumn("ok", F.lit(True))
        else:
            state = found.join(bad.withColumn("bad", F.lit(True)), "archive", "left").select(
                "archive", "length", "modification_time", F.col("bad").isNull().alias("ok")
            )
        state.write.mode("overwrite").parquet(f"{target}_archives/batch={batch_id}")

    return write


def read_records(spark: SparkSession, target: str, fields=KNOWN_FIELDS) -> DataFrame:
    """Records under `target`, a column for every field that any of its batches has promoted.

    Rows written before a field became a column lack it or, where they were written without
    `promote`, hold it in the map: it is taken from there.
    """
    more = _promoted(_registry(spark, target), fields)
    columns = ", ".join(f"`{n.replace('`', '``')}` string" for n in (*fields, *more))
    schema = f"{columns}, {OTHER_FIELDS} map<string,string>, batch long"
    if not exists(spark, target):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(target)
    named = [F.coalesce(rows[f"`{n}`"], F.col(OTHER_FIELDS)[F.lit(n)]).alias(n) for n in more]
    return rows.select(*[f"`{n}`" for n in fields], *named, _without(more), "batch")


def ingest_incremental(spark: SparkSession, location: str, target: str, checkpoint: str,
                       fields=KNOWN_FIELDS, promote: bool = False) -> None:
    """Everything that has landed, or was completed, since the last run.

    Files should land by rename; one that did not is taken up by a later run, once
    it has changed.  An archive that was read stays as it was then.
    """
    stream = landing_stream(spark, location, f"{target}_landed")
    run_available(stream, append_records(target, fields, promote), checkpoint)
