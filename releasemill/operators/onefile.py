"""A frame as one CSV file under one header.

Spark writes the rows as parts without a header, in the frame's order.  Their sizes
give each part its place in the file, so the parts are put together without any task
seeing more than a piece of them:

* on a mounted file system tasks copy pieces to their offsets, many at once;
* on HDFS the name node joins the parts' blocks, no byte is copied;
* elsewhere (object stores, whose files cannot be written in places) one task streams
  the parts in order, in bounded memory.

The file is built beside its place and renamed when it is complete.
"""

from __future__ import annotations

import csv
import io
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from releasemill.operators import sinks
from releasemill.sources.storage import open_for_read, resolve
from releasemill.workspace import _hadoop, exists, qualified

PIECE_BYTES = 128 << 20
COPY_BYTES = 4 << 20
PART = re.compile(r"part-(\d+)-.*?(?:-c(\d+))?\.csv$")
PIECES = "source string, start long, length long, place long"


def header(names: list[str]) -> bytes:
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerow(names)
    return text.getvalue().encode("utf-8")


def _parts(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Path and size of the parts with rows, in the frame's order."""
    filesystem, target = _hadoop(spark, folder)
    found = []
    for status in filesystem.listStatus(target):
        path = status.getPath()
        match = PART.match(path.getName())
        if match and status.getLen():
            found.append((int(match[1]), int(match[2] or 0), path.toString(), status.getLen()))
    return [(path, size) for _, _, path, size in sorted(found)]


def pieces(parts: list[tuple[str, int]], place: int, limit: int = PIECE_BYTES) -> list[tuple[str, int, int, int]]:
    """(source, start, length, place in the file) of what one task copies at a time."""
    out = []
    for path, size in parts:
        for start in range(0, size, limit):
            out.append((path, start, min(limit, size - start), place + start))
        place += size
    return out


def _copy(source: str, start: int, length: int, out) -> int:
    left = length
    with open_for_read(source) as body:
        body.seek(start)
        while left:
            data = body.read(min(left, COPY_BYTES))
            if not data:
                raise OSError(f"{source} ends before its listed size")
            out.write(data)
            left -= len(data)
    return length


def _by_place(target: str):
    """A repeated or speculative copy writes the same bytes to the same place."""

    def run(batches):
        _, name = resolve(target)
        for batch in batches:
            for piece in batch.to_pylist():
                with open(name, "r+b") as out:
                    out.seek(piece["place"])
                    done = _copy(piece["source"], piece["start"], piece["length"], out)
                yield pa.RecordBatch.from_pylist([{"bytes": done}])

    return run


def _in_order(target: str, head: bytes):
    """Repeated attempts write files of their own; the driver takes the one reported."""

    def run(batches):
        fs, name = resolve(target)
        own = f"{name}.{uuid.uuid4().hex}"
        done = 0
        with fs.open_output_stream(own, buffer_size=COPY_BYTES) as out:
            out.write(head)
            for batch in batches:
                for piece in batch.to_pylist():
                    done += _copy(piece["source"], piece["start"], piece["length"], out)
        yield pa.RecordBatch.from_pylist([{"bytes": done, "leaf": own.rpartition("/")[2]}])

    return run


def _join_places(spark, hidden, head, parts, limit):
    own = pieces(parts, len(head), limit)
    total = sum(size for _, size in parts)
    with open(resolve(hidden)[1], "wb") as out:
        out.write(head)
        out.truncate(len(head) + total)
    if own:
        frame = spark.createDataFrame(own, PIECES).repartitionByRange(len(own), "place")
        copied = frame.mapInArrow(_by_place(hidden), "bytes long").groupBy().sum("bytes").first()[0]
        if copied != total:
            raise OSError(f"copied {copied} of {total} bytes")
    return hidden


def _join_stream(spark, hidden, head, parts, limit):
    own = pieces(parts, len(head), limit)
    frame = spark.createDataFrame(own, PIECES).coalesce(1).sortWithinPartitions("place")
    (done,) = frame.mapInArrow(_in_order(hidden, head), "bytes long, leaf string").collect()
    if done["bytes"] != sum(size for _, size in parts):
        raise OSError("the parts were not copied whole")
    return f"{hidden.rpartition('/')[0]}/{done['leaf']}"


def _join_blocks(spark, hidden, head, parts, limit):
    filesystem, target = _hadoop(spark, hidden)
    out = filesystem.create(target, True)
    out.write(bytearray(head))
    out.close()
    gateway = spark.sparkContext._gateway
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    sources = gateway.new_array(kind, len(parts))
    for k, (path, _) in enumerate(parts):
        sources[k] = kind(path)
    if parts:
        filesystem.concat(target, sources)
    return hidden


JOINS = {"file": _join_places, "hdfs": _join_blocks}


def write_csv_file(frame: DataFrame, path: str, join=None, piece_bytes: int = PIECE_BYTES) -> str:
    """`frame` as one file: one header, blank for NULL and empty, rows in the frame's order.

    An existing file is refused.  `join` replaces the way that the storage suggests.
    A frame without rows gives the header alone.
    """
    spark = frame.sparkSession
    if exists(spark, path):
        raise FileExistsError(f"{path} exists already")
    place = qualified(spark, path)
    folder, _, leaf = place.rpartition("/")
    stage = f"{folder}/_{uuid.uuid4().hex}.{leaf}.parts"
    filesystem, staged = _hadoop(spark, stage)
    try:
        sinks.write_csv(frame, f"{stage}/rows", head=False)
        join = join or JOINS.get(place.partition(":")[0], _join_stream)
        built = join(spark, f"{stage}/whole", header(frame.columns), _parts(spark, f"{stage}/rows"), piece_bytes)
        if not filesystem.rename(_hadoop(spark, built)[1], _hadoop(spark, place)[1]):
            raise FileExistsError(f"{path} could not be put in place")
    finally:
        filesystem.delete(staged, True)
    return path
