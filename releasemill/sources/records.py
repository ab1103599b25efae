"""Archive slices to device records (bronze rows)."""

from __future__ import annotations

import gc
import itertools
import math
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from releasemill.functions import text as tx
from releasemill.model import BRONZE_SCHEMA, LAYOUT_SEP, wide_bronze_schema
from releasemill.sources import devicexml, sheet, sheetblocks
from releasemill.sources.archives import (
    SLICES_PER_CORE,
    TASK_BYTES,
    Slices,
    error_text,
    is_format_error,
    is_large_document,
    large_tasks,
    open_slice,
    work_items,
)
from releasemill.sources.storage import publish
from releasemill.workspace import fresh_path, materialise, small_side

# An output batch ends at either bound.
BATCH_ROWS = 8192
BATCH_BYTES = 32 << 20
# Characters of a batch of cut segments; a usual segment has more.
CUT_BATCH_CHARS = 1 << 20
LONGEST_DEVICE_CHARS = 64 << 20

# What parsing raises on documents and workbooks that are not what they should be.
DOCUMENT_ERRORS = (devicexml.ET.ParseError, sheet.SheetError)
LEGACY_WORKBOOK = b"\xd0\xcf\x11\xe0"


class UnreadableEntry(Exception):
    """The archive, not the document in it, is at fault."""


def _entry_blocks(entry, reader, limits):
    """Records of one entry as `(list, bytes)` blocks, each well below a batch."""
    try:
        if entry["kind"] == "xml" and entry["size"] > limits.document_bytes:
            return _stream_blocks(
                devicexml.stream_records(lambda: _readable(reader, entry))
            )
        data = reader.read(entry)
    except Exception as error:
        if not is_format_error(error):
            raise
        raise UnreadableEntry(error_text(error)) from error
    if entry["kind"] == "xml":
        return _list_blocks(devicexml.records(data), len(data))
    if data.startswith(LEGACY_WORKBOOK):
        raise sheet.SheetError("legacy .xls workbooks are not read")
    return _sheet_blocks(sheet.parts(data))


def _list_blocks(records, size):
    for first in range(0, len(records), BATCH_ROWS):
        block = records[first:first + BATCH_ROWS]
        yield block, size * len(block) // len(records)


def _stream_blocks(records):
    block, size = [], 0
    for fields in records:
        block.append(fields)
        size += sum(map(len, fields.values()))
        if len(block) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield block, size
            block, size = [], 0
    if block:
        yield block, size


def _sheet_blocks(parts):
    """Blocks of a workbook; a `Records` is one for itself."""
    for is_records, run in itertools.groupby(parts, lambda part: isinstance(part, sheetblocks.Records)):
        if is_records:
            yield from ((part, part.bytes()) for part in run)
        else:
            yield from _stream_blocks(itertools.chain.from_iterable(run))


def _readable(reader, entry):
    try:
        yield from reader.chunks(entry)
    except Exception as error:
        if not is_format_error(error):
            raise
        raise UnreadableEntry(error_text(error)) from error


class _Rows:
    """Columns of one output batch, filled block by block."""

    def __init__(self, schema, columns):
        self._schema, self._columns = schema, columns
        self._clear()

    def _clear(self):
        self._data = {field.name: [] for field in self._schema if field.name != "fields"}
        self._keys, self._values, self._offsets = [], [], [0]
        self.size = self.bytes = 0

    def like(self):
        return _Rows(self._schema, self._columns)

    @property
    def full(self):
        return self.size >= BATCH_ROWS or self.bytes >= BATCH_BYTES

    def _place(self, work, entry, count):
        for name in ("archive", "release_ord"):
            self._data[name] += [work[name]] * count
        for name in ("parent", "entry", "entry_ord"):
            self._data[name] += [entry[name]] * count
        self.size += count

    def add(self, work, entry, first, block):
        """Records of one entry, numbered from `first`."""
        self._place(work, entry, len(block))
        self._data["ord"] += range(first, first + len(block))
        layouts = list(map(LAYOUT_SEP.join, block))
        self._data["layout"] += layouts
        for name in ("error", "fatal"):
            self._data[name] += [None] * len(block)
        shapes = [layout.split(LAYOUT_SEP) for layout in set(layouts)]
        present = {name for shape in shapes for name in shape}
        if len(shapes) == 1 and present.issubset(self._columns):
            columns = dict(zip(block[0], zip(*map(dict.values, block))))
        else:
            known = present.intersection(self._columns)
            columns = {name: [fields.pop(name, None) for fields in block] for name in known}
            for fields in block:
                if fields:
                    self._keys += fields
                    self._values += fields.values()
                self._offsets.append(len(self._keys))
        self._offsets += [len(self._keys)] * (self.size + 1 - len(self._offsets))
        for name in self._columns:
            self._data[name] += columns.get(name) or [None] * len(block)

    def fail(self, work, entry, error, fatal):
        self._place(work, entry, 1)
        for name in ("ord", "layout", *self._columns):
            self._data[name].append(None)
        self._data["error"].append(error)
        self._data["fatal"].append(fatal)
        self._offsets.append(len(self._keys))

    def batches_of(self, work, entry, first, records):
        """Batches of nothing but these records of one entry, numbered from `first`."""
        columns, other = records.columns(self._columns)
        columns |= {"fields": other, "layout": records.layout}
        columns["ord"] = pa.array(np.arange(first, first + records.count))
        told = {name: work[name] for name in ("archive", "release_ord")}
        told |= {name: entry[name] for name in ("parent", "entry", "entry_ord")}
        arrays = [
            columns[f.name].cast(f.type)
            if f.name in columns
            else pa.repeat(pa.scalar(told.get(f.name), f.type), records.count)
            for f in self._schema
        ]
        whole = pa.RecordBatch.from_arrays(arrays, schema=self._schema)
        return [whole.slice(start, BATCH_ROWS) for start in range(0, records.count, BATCH_ROWS)]

    def batch(self):
        other = pa.MapArray.from_arrays(
            pa.array(self._offsets, pa.int32()),
            pa.array(self._keys, pa.string()),
            pa.array(self._values, pa.string()),
        )
        arrays = [
            other.cast(f.type) if f.name == "fields" else pa.array(self._data[f.name], f.type)
            for f in self._schema
        ]
        self._clear()
        return pa.RecordBatch.from_arrays(arrays, schema=self._schema)


def _segments(entry, reader, limits):
    return devicexml.cut_document(
        lambda: _readable(reader, entry), limits.segment_chars, LONGEST_DEVICE_CHARS
    )


def _held_batches(rows, work, entry, reader, limits):
    """All batches of a document parsed segment by segment, or None if it cannot be."""
    held, first = [], 0
    for text, fits in _segments(entry, reader, limits):
        if text is None:
            break
        try:
            found = devicexml.segment_records(text)
        except devicexml.ET.ParseError:
            return None
        for block, size in _list_blocks(found, len(text)):
            rows.add(work, entry, first, block)
            rows.bytes += size
            first += len(block)
            if rows.full:
                held.append(rows.batch())
    if not fits:
        return None
    if rows.size:
        held.append(rows.batch())
    return held


def _workbook_batches(rows, work, entry, reader, limits):
    """Batches of a workbook that could be read to its end.

    One that fits a block joins the rows of other entries; of a larger one the
    batches are held until the last row is read.
    """
    blocks = _entry_blocks(entry, reader, limits)
    begun = list(itertools.islice(blocks, 2))
    if not begun:
        return []
    if len(begun) == 1 and isinstance(begun[0][0], list):
        rows.add(work, entry, 0, begun[0][0])
        rows.bytes += begun[0][1]
        return [rows.batch()] if rows.full else []
    own, held, first = rows.like(), [], 0
    for block, size in itertools.chain(begun, blocks):
        if isinstance(block, sheetblocks.Records):
            if own.size:
                held.append(own.batch())
            held += own.batches_of(work, entry, first, block)
            first += block.count
            continue
        own.add(work, entry, first, block)
        own.bytes += size
        first += len(block)
        if own.full:
            held.append(own.batch())
    if own.size:
        held.append(own.batch())
    return held


def _entry_batches(rows, work, entry, reader, error, limits):
    try:
        if error is not None:
            raise UnreadableEntry(error_text(error))
        if entry["kind"] == "excel":
            yield from _workbook_batches(rows, work, entry, reader, limits)
            return
        if limits.document_bytes < entry["size"] <= limits.held_document_bytes:
            held = _held_batches(rows.like(), work, entry, reader, limits)
            if held is not None:
                yield from held
                return
        first = 0
        for block, size in _entry_blocks(entry, reader, limits):
            rows.add(work, entry, first, block)
            rows.bytes += size
            first += len(block)
            if rows.full:
                yield rows.batch()
    except UnreadableEntry as caught:
        rows.fail(work, entry, str(caught), True)
    except DOCUMENT_ERRORS as caught:
        rows.fail(work, entry, error_text(caught), False)


def _parse_batches(schema, columns, limits):
    def run(batches):
        rows = _Rows(schema, columns)
        # Nothing built here refers back to itself: reference counts free it,
        # and cycle searches over the many small objects would only cost time.
        gc.disable()
        try:
            for batch in batches:
                for work in batch.to_pylist():
                    for entry, reader, error in open_slice(work):
                        yield from _entry_batches(rows, work, entry, reader, error, limits)
            if rows.size:
                yield rows.batch()
        finally:
            gc.enable()

    return run


COUNTS = ("records", "failures", "fatal")


def _groups(batches):
    """Batches as tables of the size of a row group."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BATCH_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _write_batches(schema, columns, limits, folder):
    """Parse a task's slices to a Parquet file of its own; a row with its counts comes out.

    The rows never leave the task.  Its slices come in order, so every attempt writes the same file.
    """
    parse = _parse_batches(schema, columns, limits)

    def run(batches):
        found = parse(batches)
        head = next(found, None)
        if head is None:
            return
        counts = dict.fromkeys(COUNTS, 0)

        def write(out):
            with pq.ParquetWriter(out, schema) as file:
                for group in _groups(itertools.chain([head], found)):
                    good = group["error"].null_count
                    counts["records"] += good
                    counts["failures"] += group.num_rows - good
                    counts["fatal"] += pc.sum(group["fatal"]).as_py() or 0
                    file.write_table(group, row_group_size=group.num_rows)

        publish(f"{folder}/part-{TaskContext.get().partitionId():06d}.parquet", write)
        yield pa.RecordBatch.from_pylist([counts])

    return run


def _write_slices(slices: Slices, schema, columns) -> tuple[DataFrame, dict[str, int]]:
    """Rows of the slices and of archives that could not be listed, as a table in the workspace, and their counts."""
    spark = slices.frame.sparkSession
    folder = fresh_path(spark, "records")
    run = _write_batches(to_arrow_schema(schema), tuple(columns), slices.limits, folder)
    ordered = work_items(slices).sortWithinPartitions("archive", "release_ord", "slice_no")
    written = ordered.mapInArrow(run, ", ".join(f"{name} long" for name in COUNTS))
    total = written.agg(*[F.sum(name).alias(name) for name in COUNTS]).first()
    counts = {name: total[name] or 0 for name in COUNTS}
    if slices.failed or not any(counts.values()):
        told = {"archive", "release_ord", "error", "fatal"}
        unlisted = slices.frame.filter(F.col("error").isNotNull()).withColumn("fatal", F.lit(True)).select(
            *[F.col(f.name) if f.name in told else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        )
        unlisted.write.mode("append").parquet(folder)
        counts["failures"] += slices.failed
        counts["fatal"] += slices.failed
    return spark.read.schema(schema).parquet(folder), counts


def _read_slices(work: DataFrame, schema, columns, limits) -> DataFrame:
    return work.mapInArrow(
        _parse_batches(to_arrow_schema(schema), tuple(columns), limits), schema
    )


def parse_slices(slices: Slices, columns=()) -> DataFrame:
    """The rows of `parse_slices_counted`."""
    return parse_slices_counted(slices, columns)[0]


def parse_slices_counted(slices: Slices, columns=()) -> tuple[DataFrame, dict[str, int] | None]:
    """Records and failures of every entry, one row each (written to the workspace), and their counts.

    The counts (`records`, `failures`, `fatal`) are taken by the write itself; they are
    None where documents are cut into segments, as the rows of those that must be read
    again are known only afterwards.

    `columns` come out as columns of their own; `fields` maps whatever else a
    record holds.  An entry that fails gives one row with `error` set; `fatal`
    marks those that void their whole archive.
    """
    schema = wide_bronze_schema(columns) if columns else BRONZE_SCHEMA
    usual = slices
    if slices.documents:
        usual = replace(
            slices,
            frame=slices.frame.filter(~is_large_document(slices.limits)),
            count=slices.count - slices.documents,
            bytes=slices.bytes - slices.document_bytes,
        )
    rows, counts = _write_slices(usual, schema, columns)
    if slices.documents:
        return rows.unionByName(_parse_large(slices, schema, columns)), None
    return rows, counts


# --- documents too large for one task ------------------------------------------------

SEGMENT_SCHEMA = T.StructType(
    [
        *(BRONZE_SCHEMA[c] for c in ("archive", "release_ord", "parent", "entry", "entry_ord")),
        T.StructField("segment", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("fits", T.BooleanType()),
    ]
)
NOT_SPLIT = "document cannot be split"


def _cut_batches(schema, limits):
    def rows(work):
        for entry, reader, _ in open_slice(work):
            place = {k: entry[k] for k in ("parent", "entry", "entry_ord")}
            place |= {k: work[k] for k in ("archive", "release_ord")}
            try:
                for number, (text, fits) in enumerate(_segments(entry, reader, limits)):
                    yield {**place, "segment": number, "text": text, "fits": fits}
            except UnreadableEntry:
                yield {**place, "segment": -1, "text": None, "fits": False}

    def run(batches):
        held, chars = [], 0
        for batch in batches:
            for work in batch.to_pylist():
                for row in rows(work):
                    held.append(row)
                    chars += len(row["text"] or "")
                    if chars >= CUT_BATCH_CHARS or len(held) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, chars = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    return run


def _segment_batches(schema, columns):
    def run(batches):
        rows = _Rows(schema, columns)
        for batch in batches:
            for row in batch.to_pylist():
                if row["text"] is None:
                    if not row["fits"]:
                        rows.fail(row, row, NOT_SPLIT, None)
                    continue
                try:
                    found = devicexml.segment_records(row["text"])
                except devicexml.ET.ParseError:
                    rows.fail(row, row, NOT_SPLIT, None)
                    continue
                if found:
                    # Segments are numbered in the high half, their records in the low;
                    # `_dense_ord` turns this into one sequence.
                    rows.add(row, row, row["segment"] << 32, found)
                    rows.bytes += len(row["text"])
                    if rows.full:
                        yield rows.batch()
        if rows.size:
            yield rows.batch()

    return run


def _parse_large(slices: Slices, schema, columns) -> DataFrame:
    """Cut each document in one task, parse its segments in many.

    Inflating is sequential, parsing is most of the work.  A document whose
    segments do not stand by themselves is read again as one stream.
    """
    limits = slices.limits
    documents = slices.frame.filter(is_large_document(limits))
    cores = documents.sparkSession.sparkContext.defaultParallelism
    segments = math.ceil(slices.document_bytes / limits.segment_chars)
    tasks = max(
        math.ceil(slices.document_bytes / TASK_BYTES), min(segments, SLICES_PER_CORE * cores)
    )
    parsed = materialise(
        documents.repartition(large_tasks(slices, slices.documents, slices.document_bytes))
        .mapInArrow(_cut_batches(to_arrow_schema(SEGMENT_SCHEMA), limits), SEGMENT_SCHEMA)
        .repartition(tasks)
        .mapInArrow(_segment_batches(to_arrow_schema(schema), tuple(columns)), schema),
        "segments",
    )
    place = ["archive", "release_ord", "entry_ord"]
    whole = parsed.filter(F.col("error").isNotNull()).select(*place).distinct()
    again = whole.count()
    if again == 0:
        return _dense_ord(parsed, place)
    # Each of these is a slice of its own, so the set is far smaller than the data.
    held = documents.select("*", F.col("entries")[0]["entry_ord"].alias("entry_ord"))
    whole = small_side(whole, again)
    stream = held.join(whole, place, "left_semi").drop("entry_ord")
    restreamed = large_tasks(slices, again, slices.document_bytes)
    streamed = materialise(_read_slices(stream.repartition(restreamed), schema, columns, limits), "records")
    return _dense_ord(parsed.join(whole, place, "left_anti"), place).unionByName(streamed)


def _dense_ord(parsed: DataFrame, place) -> DataFrame:
    """Number the records of each document 0, 1, ... over its segments.

    The segments' record counts, a row for each, give the offsets.
    """
    segment = F.shiftright("ord", 32).alias("__segment")
    before = Window.partitionBy(*place).orderBy("__segment").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = materialise(
        parsed.groupBy(*place, segment).agg(F.count("*").alias("__rows")).select(
            *place, "__segment",
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"),
        ),
        "offsets",
    )
    number = F.col("__offset") + F.col("ord").bitwiseAND(F.lit((1 << 32) - 1))
    return (
        parsed.select("*", segment)
        .join(small_side(offsets, offsets.count()), [*place, "__segment"])
        .withColumn("ord", number)
        .select(*parsed.columns)
    )


# --- JVM-only variant --------------------------------------------------------------

NATIVE_SHAPE = "devices struct<device:array<map<string,string>>>, broken string"


def parse_payloads_native(payloads: DataFrame) -> DataFrame:
    """Records of XML payloads through `from_xml`: no Python after unzipping.

    A payload that cannot be read or parsed gives one row with `error` set, as does
    an archive that could not be listed.  A document is one cell, so it has to fit
    an executor's memory and stay below 2 GB.

    Differs from `parse_slices` where a document holds several `devices`
    elements (the last counts) or nested children (raw inner XML is kept).
    """
    text = tx.decode_charset(F.col("payload"))
    cleaned = tx.drop_encoding(tx.clean_text(text))
    place = ["archive", "parent", "entry", "entry_ord"]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    parsed = payloads.filter(
        (F.col("kind") == "xml") | F.col("error").isNotNull()
    ).select(*place, "error", F.from_xml(cleaned, NATIVE_SHAPE, options).alias("doc"))
    broken = F.when(F.col("doc.broken").isNotNull(), "ParseError: not well-formed")
    # A failed payload passes as one empty device.
    failed = F.array(F.create_map().cast("map<string,string>"))
    checked = parsed.select(*place, "doc", F.coalesce("error", broken).alias("error"))
    devices = F.when(F.col("error").isNotNull(), failed).otherwise(F.col("doc.devices.device"))
    return checked.select(*place, "error", F.posexplode(devices).alias("ord", "raw")).select(
        *place,
        F.when(F.col("error").isNull(), F.col("ord").cast("long")).alias("ord"),
        F.transform_values("raw", lambda _, value: tx.strip_text(value)).alias("fields"),
        "error",
    )
