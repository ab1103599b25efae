"""Tables whose appends are there whole or not at all, and once for each run.

An append writes its parts into folders that no reader knows, audits what was written,
and then publishes them under the name of its run: one file that lists them, created
in a single step and only if the run has none.  A run that is repeated adds nothing, one
that fails leaves nothing but unlisted folders, which `vacuum` deletes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasemill.workspace import _hadoop, exists, qualified

MANIFEST_SCHEMA = "run string, name string, folder string, rows long, layout string"


class LostRows(Exception):
    """An append wrote another number of rows than it was given."""


class SmallFiles:
    """Small files of one folder, each created in a single step.

    What is the same for all of them is asked of Java once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        jvm = spark.sparkContext._jvm
        self._filesystem, self._folder = _hadoop(spark, folder)
        self._path = jvm.org.apache.hadoop.fs.Path
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._filesystem.makeQualified(self._folder).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
        )
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        self._options = spark.sparkContext._gateway.new_array(kind, 1)
        self._options[0] = kind.NONE  # an existing file stays

    def _at(self, name: str):
        return self._path(self._folder, name)

    def create(self, name: str, text: str) -> bool:
        """Create a file with `text`; False, and no change, where it is there already.

        The text is written beside it and renamed, so the file is never seen half written.
        """
        target, hidden = self._at(name), self._at(f"_{uuid.uuid4().hex}.{name}")
        out = self._filesystem.create(hidden, False)  # and the folder, where there is none
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        try:
            self._context.rename(hidden, target, self._options)
            return True
        except Exception:
            self._filesystem.delete(hidden, False)
            if self._filesystem.exists(target):
                return False
            raise

    def read(self, name: str) -> str | None:
        """Text of a file, or None where there is none."""
        target = self._at(name)
        try:
            size = self._filesystem.getFileStatus(target).getLen()
            stream = self._filesystem.open(target)
        except Exception:
            if not self._filesystem.exists(target):
                return None
            raise
        try:
            return bytes(stream.readNBytes(int(size))).decode("utf-8")
        finally:
            stream.close()

    def names(self) -> list[str]:
        """Files that are there whole."""
        if not self._filesystem.exists(self._folder):
            return []
        names = [status.getPath().getName() for status in self._filesystem.listStatus(self._folder)]
        return [name for name in names if name[0] not in "_."]

    def delete(self, name: str) -> None:
        self._filesystem.delete(self._at(name), False)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """`SmallFiles.create` of a single file."""
    folder, _, name = path.rpartition("/")
    return SmallFiles(spark, folder).create(name, text)


def read_text(spark: SparkSession, path: str) -> str | None:
    """`SmallFiles.read` of a single file."""
    folder, _, name = path.rpartition("/")
    return SmallFiles(spark, folder).read(name)


class PublishedTable:
    """Parts (frames under names) that runs append together."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, qualified(spark, path).rstrip("/")

    def _manifest(self, run: str) -> str:
        return f"{self.path}/runs/{run}.json"

    def has(self, run: str) -> bool:
        return exists(self.spark, self._manifest(run))

    def append(self, run: str, parts: dict[str, DataFrame], expected: dict[str, int] | None = None) -> bool:
        """Publish `parts` as `run`; False where that run is published already.

        The rows that tasks were given are counted while they write, and must be those
        found in the files (and those `expected`), else the append fails.
        """
        if not run or set(run) & set("/\\\0"):
            raise ValueError(f"{run!r} cannot name a run")
        if self.has(run):
            return False
        attempt, listed = uuid.uuid4().hex, []
        for name, frame in parts.items():
            folder = f"data/{name}-{attempt}"
            seen = Observation(f"{name}-{attempt}")
            frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.path}/{folder}")
            rows = seen.get["rows"]
            found = self.spark.read.schema(frame.schema).parquet(f"{self.path}/{folder}").count()
            if found != rows or expected and expected.get(name, rows) != rows:
                raise LostRows(f"{name}: {rows} rows written, {found} found, {(expected or {}).get(name)} expected")
            listed.append({"run": run, "name": name, "folder": folder, "rows": rows, "layout": frame.schema.json()})
        text = "\n".join(map(json.dumps, listed)) + "\n"
        return create_once(self.spark, self._manifest(run), text)

    def parts(self) -> DataFrame:
        """What is published: `run, name, folder, rows, layout`, a row for each part of a run."""
        if not exists(self.spark, f"{self.path}/runs"):
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.path}/runs")

    def read(self, name: str, schema: T.StructType | str) -> DataFrame:
        """Rows of a part from all runs, columns of later runs added to `schema`; earlier rows lack them."""
        listed = self.parts().where(F.col("name") == name)
        folders = [row["folder"] for row in listed.select("folder").collect()]
        empty = self.spark.createDataFrame([], schema)
        merged, kinds = list(empty.schema), {f.name: f.dataType for f in empty.schema}
        for row in listed.select("layout").distinct().orderBy("layout").collect():
            for field in T.StructType.fromJson(json.loads(row["layout"])):
                if kinds.setdefault(field.name, field.dataType) != field.dataType:
                    raise TypeError(f"{name}: column {field.name} was published as several types")
                if field.name not in {f.name for f in merged}:
                    merged.append(field)
        if not folders:
            return empty
        return self.spark.read.schema(T.StructType(merged)).parquet(*[f"{self.path}/{f}" for f in folders])

    def vacuum(self) -> int:
        """Delete the folders that no run lists, while no append is under way; returns their number."""
        filesystem, data = _hadoop(self.spark, f"{self.path}/data")
        if not filesystem.exists(data):
            return 0
        listed = {row["folder"].partition("/")[2] for row in self.parts().select("folder").collect()}
        gone = [s.getPath() for s in filesystem.listStatus(data) if s.getPath().getName() not in listed]
        for path in gone:
            filesystem.delete(path, True)
        return len(gone)
