"""Release archives as DataFrames: listing, slicing, payloads."""

from __future__ import annotations

import hashlib
import io
import math
import zipfile
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from releasemill.model import PAYLOAD_SCHEMA, SLICE_SCHEMA
from releasemill.sources import zipentries as ze
from releasemill.sources.storage import open_for_read, publish
from releasemill.workspace import fresh_path, materialise

# Uncompressed bytes per slice (unit of work) and per parse task.  A nested archive
# counts as what it holds, by the usual ratio of XML.  Slices get
# smaller than the maximum where the whole input would make too few of them.
MIN_SLICE_BYTES = 1 << 20
MAX_SLICE_BYTES = 16 << 20
TASK_BYTES = 64 << 20
SLICE_ENTRIES = 4096
SLICES_PER_CORE = 4
USUAL_RATIO = 8  # uncompressed to compressed size
# Archives listed per task: few while tasks are scarce, more for a large landing.
FEW_ARCHIVES = 8
MANY_ARCHIVES = 64
# A nested archive above this size is split into slices of its own.  A deflated one
# can only be read from its start, so it is inflated once into the workspace.
NESTED_SPLIT_BYTES = 4 << 20
# A document above this size is cut up and parsed by several tasks.
SPLIT_DOCUMENT_BYTES = 64 << 20
# A document above the first size is parsed in segments, its records held as
# Arrow batches; above the second as a stream, in bounded memory.
DOCUMENT_BYTES = 16 << 20
HELD_DOCUMENT_BYTES = 64 << 20
# Segments of a document parsed by several tasks.
SEGMENT_CHARS = 4 << 20


@dataclass(frozen=True)
class Limits:
    """Sizes that choose how an entry is read; any choice gives the same rows."""

    nested_bytes: int
    split_document_bytes: int
    document_bytes: int
    held_document_bytes: int
    segment_chars: int


def usual_limits() -> Limits:
    return Limits(
        NESTED_SPLIT_BYTES, SPLIT_DOCUMENT_BYTES, DOCUMENT_BYTES, HELD_DOCUMENT_BYTES, SEGMENT_CHARS
    )


def is_format_error(error: Exception) -> bool:
    """True when the archive is at fault.  Storage failures are left to task retry."""
    return isinstance(error, ze.FORMAT_ERRORS)


def error_text(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def scan_archives(spark: SparkSession, location, glob: str = "*.zip",
                  partitioned: bool = False) -> DataFrame:
    """Landed archives: `archive, file_name, length, modification_time, release_ord`.

    The file content is never read here: only the metadata columns of the
    binary source survive column pruning.  With `partitioned`, folders such as
    `kind=daily/date=20260326` become columns, and a filter on them lists only
    the folders it needs; otherwise all folders below are searched.
    """
    return with_archive_columns(
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", not partitioned)
        .load(location)
    )


def with_archive_columns(files: DataFrame) -> DataFrame:
    source = ("path", "modificationTime", "length", "content")
    return files.select(
        F.col("path").alias("archive"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modification_time"),
        F.lit(0).cast("long").alias("release_ord"),
        *[name for name in files.columns if name not in source],
    )


# --- task side -----------------------------------------------------------------


def _work_bytes(entry):
    weight = {"zip": USUAL_RATIO, None: 0}.get(entry["kind"], 1)
    return weight * entry["size"]


class _Slicer:
    """Groups an archive's entries, in order, into slices of bounded size."""

    def __init__(self, archive, release_ord, limit, split, file=None):
        self._base = {"archive": archive, "release_ord": release_ord, "file": file, "error": None}
        self._limit, self._split, self._alone = limit, split, False
        self._entries, self._bytes, self.count = [], 0, 0

    def add(self, entry):
        size = _work_bytes(entry)
        full = self._bytes + size > self._limit or len(self._entries) >= SLICE_ENTRIES
        alone = size > MAX_SLICE_BYTES or entry["kind"] == "xml" and size > self._split
        if self._entries and (full or alone or self._alone):
            yield self.close()
        self._alone = alone or size > self._limit
        self._entries.append(entry)
        self._bytes += size

    def close(self):
        nested = [e["size"] for e in self._entries if e["kind"] == "zip"]
        row = {
            **self._base,
            "slice_no": self.count,
            "slice_bytes": self._bytes,
            "nested_bytes": max(nested, default=0),
            "entries": self._entries,
        }
        self._entries, self._bytes, self.count = [], 0, self.count + 1
        return row

    def failed(self, error):
        return {
            **self._base,
            "slice_no": -1,
            "slice_bytes": 0,
            "nested_bytes": 0,
            "entries": [],
            "error": error_text(error),
        }


def _archive_slices(archive, release_ord, limit, split):
    slicer = _Slicer(archive, release_ord, limit, split)
    with open_for_read(archive) as stream:  # storage at fault: not the archive
        try:
            for entry in ze.list_directory(stream):
                entry["entry_ord"] = ze.outer_ord(entry["entry_ord"])
                yield from slicer.add(entry)
            yield slicer.close()
        except Exception as error:
            if not is_format_error(error):
                raise
            yield slicer.failed(error)


def _unpacked(outer, info, row, item, folder):
    """A deflated nested archive as a file of its own, inflated once."""
    name = hashlib.sha256(row["archive"].encode()).hexdigest()[:24]
    path = f"{folder}/{name}-{item['entry_ord']}.zip"

    def copy(out):
        with ze.library():
            body = outer.open(info)
        with body:
            ze.copy(body, out)

    publish(path, copy)
    return path


def _nested_slices(row, limit, folder, split, document):
    """Slices of the large nested archives a slice holds.

    A stored one is listed and read in place, any other from its copy in `folder`.
    """
    large = [e for e in row["entries"] if e["kind"] == "zip" and e["size"] > split]
    rest = [e for e in row["entries"] if e not in large]
    yield {**row, "entries": rest, "nested_bytes": 0,
           "slice_bytes": sum(map(_work_bytes, rest))}
    slicer = _Slicer(row["archive"], row["release_ord"], limit, document)
    with open_for_read(row["archive"]) as stream:
        try:
            with ze.library():
                outer = zipfile.ZipFile(stream)
            with outer:
                by_offset = {info.header_offset: info for info in outer.infolist()}
                for item in large:
                    info = by_offset[item["offset"]]
                    path, base, body = None, 0, None
                    if item["method"] == ze.STORED:
                        base = ze.data_offset(stream, item["offset"])
                        with ze.library():
                            body = outer.open(info)
                    else:
                        path = _unpacked(outer, info, row, item, folder)
                        body = open_for_read(path)
                    slicer = _Slicer(row["archive"], row["release_ord"], limit, document, path)
                    with body:
                        for entry in ze.list_directory(body, item["entry"], base, item["entry_ord"]):
                            for part in slicer.add(entry):
                                yield {**part, "slice_no": item["entry_ord"] + part["slice_no"]}
                    part = slicer.close()
                    yield {**part, "slice_no": item["entry_ord"] + part["slice_no"]}
        except Exception as error:
            if not is_format_error(error):
                raise
            yield slicer.failed(error)


def _rows_to_batches(rows, schema, size):
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _list_batches(schema, limit, split):
    def run(batches):
        rows = (
            row
            for batch in batches
            for item in batch.to_pylist()
            for row in _archive_slices(item["archive"], item["release_ord"], limit, split)
        )
        return _rows_to_batches(rows, schema, 64)

    return run


def _expand_batches(schema, limit, folder, split, document):
    def run(batches):
        rows = (
            row
            for batch in batches
            for item in batch.to_pylist()
            for row in _nested_slices(item, limit, folder, split, document)
        )
        return _rows_to_batches(rows, schema, 16)

    return run


def open_slice(row):
    """(entry, reader) pairs of a slice in storage order; small nested archives open up.

    Yields `(entry, reader, None)`, or `(entry, None, error)` when the nested
    archive cannot be read.  Of a slice with `only` just the entries with these places.
    """
    only = row.get("only")
    with open_for_read(row["file"] or row["archive"]) as stream:
        outer = ze.ArchiveReader(stream)
        wanted = [entry for entry in row["entries"] if entry["kind"]]
        for entry in sorted(wanted, key=lambda e: e["offset"]):
            if entry["kind"] != "zip":
                yield entry, outer, None
                continue
            try:
                nested = io.BytesIO(outer.read(entry))
                inner = list(
                    ze.list_directory(nested, entry["entry"], ord_base=entry["entry_ord"])
                )
            except Exception as error:
                if not is_format_error(error):
                    raise
                yield entry, None, error
                continue
            reader = ze.ArchiveReader(nested)
            for item in inner:
                if item["kind"] and (only is None or item["entry_ord"] in only):
                    yield item, reader, None


def _payload_batches(schema):
    def rows(batches):
        for batch in batches:
            for work in batch.to_pylist():
                for entry, reader, error in open_slice(work):
                    payload = None
                    if error is None:
                        try:
                            payload = reader.read(entry)
                        except Exception as caught:
                            if not is_format_error(caught):
                                raise
                            error = caught
                    yield {
                        "archive": work["archive"],
                        "payload": payload,
                        "error": error_text(error) if error else None,
                        **{k: entry[k] for k in ("entry", "parent", "entry_ord", "kind", "size")},
                    }

    def run(batches):
        for row in rows(batches):
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    return run


# --- driver side -----------------------------------------------------------------


@dataclass
class Slices:
    """Sliced directories, with the totals later steps are planned by."""

    frame: DataFrame
    limits: Limits
    count: int
    bytes: int
    nested: int
    documents: int
    document_bytes: int
    failed: int = 0  # archives that could not be listed

    @classmethod
    def of(cls, frame: DataFrame, limits: Limits) -> Slices:
        document = is_large_document(limits)
        totals = frame.agg(
            F.count_if(is_work()).alias("count"),
            F.sum("slice_bytes").alias("bytes"),
            F.count_if(F.col("nested_bytes") > limits.nested_bytes).alias("nested"),
            F.count_if(document).alias("documents"),
            F.sum(F.when(document, F.col("slice_bytes"))).alias("document_bytes"),
            F.count_if(F.col("error").isNotNull()).alias("failed"),
        ).first()
        return cls(frame, limits, *(value or 0 for value in totals))


def is_work():
    return F.col("error").isNull() & (F.size("entries") > 0)


def is_large_document(limits: Limits):
    """A slice that is one document too large for one task.

    Entries of that size have a slice to themselves.
    """
    split = limits.split_document_bytes
    return (F.col("slice_bytes") > split) & (F.size("entries") == 1) & F.exists(
        "entries", lambda e: (e["kind"] == "xml") & (e["size"] > split)
    )


def list_slices(archives: DataFrame, limits: Limits | None = None) -> Slices:
    """Directory of every archive, cut into slices (written once to the workspace).

    Small rows stand for large files, so the partition count follows the number
    of archives, not their bytes in the listing.
    """
    limits = limits or usual_limits()
    cores = archives.sparkSession.sparkContext.defaultParallelism
    total = archives.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
    tasks = min(
        math.ceil(total["n"] / FEW_ARCHIVES),
        max(math.ceil(total["n"] / MANY_ARCHIVES), SLICES_PER_CORE * cores),
    )
    even = (total["bytes"] or 0) * USUAL_RATIO // (cores * SLICES_PER_CORE)
    limit = min(max(even, MIN_SLICE_BYTES), MAX_SLICE_BYTES)
    listed = (
        archives.select("archive", "release_ord")
        .repartition(max(1, tasks))
        .mapInArrow(
            _list_batches(to_arrow_schema(SLICE_SCHEMA), limit, limits.split_document_bytes),
            SLICE_SCHEMA,
        )
    )
    slices = Slices.of(materialise(listed, "slices"), limits)
    return split_large_nested(slices, limit) if slices.nested else slices


def large_tasks(slices: Slices, items: int, size_bytes: int) -> int:
    """Tasks for large `items` of a size in all: one each where they are large indeed.

    A shuffle has blocks by the product of its sides, so there are no more tasks than the bytes need.
    """
    cores = slices.frame.sparkSession.sparkContext.defaultParallelism
    return max(1, min(items, max(math.ceil(size_bytes / TASK_BYTES), SLICES_PER_CORE * cores)))


def split_large_nested(slices: Slices, limit: int) -> Slices:
    """Open up nested archives too large to be one unit of work."""
    large = F.col("nested_bytes") > slices.limits.nested_bytes
    expanded = (
        slices.frame.filter(large)
        .repartition(large_tasks(slices, slices.nested, slices.bytes))
        .mapInArrow(
            _expand_batches(
                to_arrow_schema(SLICE_SCHEMA), limit,
                fresh_path(slices.frame.sparkSession, "nested"), slices.limits.nested_bytes,
                slices.limits.split_document_bytes,
            ),
            SLICE_SCHEMA,
        )
    )
    rest = slices.frame.filter(~large)
    return Slices.of(rest.unionByName(materialise(expanded, "nested-slices")), slices.limits)


def chosen_entries(slices: Slices, places: DataFrame) -> Slices:
    """Slices of just the entries at `places` (`archive, release_ord, entry_ord`, each once).

    An entry is a slice of its own, with those it sits in where a nested archive is not
    split up; of such a one `only` names the entries that are wanted.
    """
    key = ["archive", "release_ord", "outer"]
    entries = slices.frame.filter(is_work()).select(
        "archive", "release_ord", "file", F.explode("entries").alias("e"), F.col("e.entry_ord").alias("outer")
    )
    nested = F.col("e.kind") == "zip"
    direct = entries.filter(~nested).join(
        places.select("archive", "release_ord", F.col("entry_ord").alias("outer")), key
    ).withColumn("only", F.lit(None).cast("array<long>"))
    # As many as one nested archive below the splitting size holds.
    inside = places.groupBy(
        "archive", "release_ord", F.shiftleft(F.shiftright("entry_ord", 32), 32).alias("outer")
    ).agg(F.collect_set("entry_ord").alias("only"))
    chosen = direct.unionByName(entries.filter(nested).join(inside, key))
    weight = F.when(nested, USUAL_RATIO).otherwise(1) * F.col("e.size")
    rows = chosen.select(
        "archive", "release_ord", F.col("outer").alias("slice_no"), weight.cast("long").alias("slice_bytes"),
        F.lit(0).cast("long").alias("nested_bytes"), F.array("e").alias("entries"), "file",
        F.lit(None).cast("string").alias("error"), "only",
    )
    return Slices.of(materialise(rows, "chosen"), slices.limits)


def work_items(slices: Slices) -> DataFrame:
    """Slices dealt out evenly over parse tasks, since their sizes are alike.

    Ranges of a hash split evenly even when there are about as many tasks as
    slices, where round robin or plain hashing would leave tasks empty.
    """
    cores = slices.frame.sparkSession.sparkContext.defaultParallelism
    tasks = min(
        slices.count,
        max(
            math.ceil(slices.bytes / TASK_BYTES),
            min(math.ceil(slices.bytes / MIN_SLICE_BYTES), SLICES_PER_CORE * cores),
        ),
    )
    return slices.frame.filter(is_work()).repartitionByRange(
        max(1, tasks), F.xxhash64("archive", "slice_no")
    )


def entry_manifest(slices: Slices) -> DataFrame:
    """One row per directory entry, ignored ones included."""
    listed = slices.frame.select("archive", "release_ord", F.explode("entries").alias("e"))
    return listed.select(
        "archive", "release_ord", "e.entry", "e.parent", "e.entry_ord", "e.kind",
        "e.size", "e.packed",
    )


def entry_payloads(slices: Slices) -> DataFrame:
    """Bytes of every entry, nested ones included.

    One that cannot be read has `error` instead, as has the one row of an archive
    that could not be listed.
    """
    read = work_items(slices).mapInArrow(
        _payload_batches(to_arrow_schema(PAYLOAD_SCHEMA)), PAYLOAD_SCHEMA
    )
    unlisted = slices.frame.filter(F.col("error").isNotNull()).select("archive", "error")
    return read.unionByName(unlisted, allowMissingColumns=True)


def kind_of(name):
    """Column form of the suffix dispatch."""
    return (
        F.when(F.endswith(name, F.lit(".zip")), "zip")
        .when(F.endswith(name, F.lit(".xml")), "xml")
        .when(F.endswith(name, F.lit(".xls")) | F.endswith(name, F.lit(".xlsx")), "excel")
    )
