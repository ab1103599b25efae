"""Stream source of a landing folder that tells versions of files, not names.

Spark's own file source remembers names alone: a file that was incomplete when it was
listed never comes back.  This one knows each file by path, length and time.  Every
listing that finds something writes what is new or changed as the next numbered entry
of a log; an offset is the number of an entry, so a replayed batch reads the same rows
whatever has happened in the folder since.  A restarted source reads the newest
summary of the log and the entries after it.
"""

from __future__ import annotations

import datetime
import fnmatch

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from releasemill.sources.storage import open_for_read, publish, resolve

NAME = "releasemill_landing"
SCHEMA = (
    "archive string, file_name string, length long, modification_time timestamp, release_ord long"
)
# Files of a task, and entries after which the log is summed up.
PARTITION_FILES = 10_000
SUMMARY_ENTRIES = 16

VERSIONS = pa.schema([("path", pa.string()), ("length", pa.int64()), ("time", pa.int64())])


def _write(path: str, versions: dict[str, tuple[int, int]]) -> None:
    """The versions as one file, there whole or not at all."""
    names = sorted(versions)
    columns = [names, [versions[n][0] for n in names], [versions[n][1] for n in names]]
    table = pa.table([pa.array(c, f.type) for c, f in zip(columns, VERSIONS)], schema=VERSIONS)
    publish(path, lambda out: pq.write_table(table, out))


def _read(path: str) -> pa.Table:
    with open_for_read(path) as body:
        return pq.read_table(pa.BufferReader(body.read()))


def list_versions(location: str, glob: str) -> dict[str, tuple[int, int]]:
    """Path -> (length, microseconds) of the files below a folder; empty and hidden ones are not there."""
    fs, base = resolve(location)
    base = base.rstrip("/")
    found = {}
    for info in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True, recursive=True)):
        below = info.path[len(base) :].lstrip("/")
        hidden = any(part.startswith(("_", ".")) for part in below.split("/"))
        if info.type == pafs.FileType.File and info.size and not hidden:
            if fnmatch.fnmatchcase(below.rpartition("/")[2], glob):
                found[f"{location.rstrip('/')}/{below}"] = (info.size, (info.mtime_ns or 0) // 1000)
    return found


class Log:
    """Numbered entries of versions in a folder of shared storage; one stream writes it."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.known: dict[str, tuple[int, int]] = {}
        fs, base = resolve(self.folder)
        names = [i.base_name for i in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))]

        def numbers(kind):
            return sorted(int(n[len(kind) + 1 : -8]) for n in names if n.startswith(f"{kind}-"))

        entries, summaries = numbers("entry"), numbers("summary")
        self.last = entries[-1] if entries else 0
        summed = summaries[-1] if summaries else 0
        if summed:
            self._learn(_read(self._path("summary", summed)))
        for number in entries:
            if number > summed:
                self._learn(_read(self.entry(number)))

    def _path(self, kind: str, number: int) -> str:
        return f"{self.folder}/{kind}-{number:012d}.parquet"

    def entry(self, number: int) -> str:
        return self._path("entry", number)

    def _learn(self, table: pa.Table) -> None:
        columns = (table.column(name).to_pylist() for name in VERSIONS.names)
        self.known.update((path, (length, time)) for path, length, time in zip(*columns))

    def note(self, found: dict[str, tuple[int, int]]) -> int:
        """Write what differs from all entries so far as the next one; the last number."""
        new = {path: version for path, version in found.items() if self.known.get(path) != version}
        if new:
            _write(self.entry(self.last + 1), new)
            self.last += 1
            self.known.update(new)
            if self.last % SUMMARY_ENTRIES == 0:
                _write(self._path("summary", self.last), self.known)
        return self.last


class Part(InputPartition):
    """Rows of an entry; `later` are the entries of the batch that may hold newer versions."""

    def __init__(self, entry: str, start: int, rows: int, later: list[str]):
        self.entry, self.start, self.rows, self.later = entry, start, rows, later


class Reader(DataSourceStreamReader):
    def __init__(self, options):
        self.location, self.folder = options["path"], options["log"]
        self.glob = options.get("glob", "*")
        self.log: Log | None = None

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        self.log = self.log or Log(self.folder)
        return {"entry": self.log.note(list_versions(self.location, self.glob))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        log = self.log = self.log or Log(self.folder)
        parts = []
        for number in range(start["entry"] + 1, end["entry"] + 1):
            with open_for_read(log.entry(number)) as body:
                size = pq.read_metadata(pa.PythonFile(body, "r")).num_rows
            later = [log.entry(n) for n in range(number + 1, end["entry"] + 1)]
            for first in range(0, size, PARTITION_FILES):
                parts.append(Part(log.entry(number), first, PARTITION_FILES, later))
        return parts

    def read(self, partition: Part):
        """A file's newest version in the batch."""
        table = _read(partition.entry).slice(partition.start, partition.rows)
        for path in partition.later:
            newer = pc.is_in(table.column("path"), value_set=_read(path).column("path"))
            table = table.filter(pc.invert(newer))
        for row in table.to_pylist():
            time = datetime.datetime.fromtimestamp(row["time"] / 1e6, datetime.timezone.utc)
            yield row["path"], row["path"].rpartition("/")[2], row["length"], time, 0


class LandingSource(DataSource):
    """Options: `path` (folder), `log` (folder of this stream's own), `glob` (file names)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LandingSource)
