"""Captured release feeds (RSS) as DataFrames."""

from __future__ import annotations

import itertools
import logging

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from releasemill.functions.text import clean_text
from releasemill.sources import feedxml
from releasemill.sources.archives import SLICES_PER_CORE
from releasemill.sources.storage import open_for_read, resolve
from releasemill.workspace import _hadoop, materialise

log = logging.getLogger(__name__)

ITEM = "struct<title:string,link:string>"
# RSS 2.0 keeps its items under `channel`, RSS 1.0 directly under the root.
FEED_SHAPE = f"channel struct<item:array<{ITEM}>>, item array<{ITEM}>"

VERDICT_SCHEMA = f"feed string, path string, modificationTime timestamp, verdict string, lost int, items array<{ITEM}>"

# Captures of each feed that are read at once, newest first: mostly the newest will do.
FIRST_ROUND, LATER_ROUNDS = 1, 16

FILE_SCHEMA = "path string, modificationTime timestamp, length long"
_FILE_COLUMNS = ["path", "modificationTime", "length"]
# Rows of a batch of listed files or read captures, and bytes of the latter.
LISTED_ROWS, READ_BYTES = 1024, 1 << 20


class UnreadableFeed(Exception):
    """None of a feed's captures can be read."""


def feed_items(feeds: DataFrame, xml: Column, *keep) -> DataFrame:
    """Items of feed documents in feed order: `title, link` (missing is empty), `pos`.

    One row of `feeds` is one captured feed response.  Stray control characters
    and bare ampersands do not spoil it.
    """
    parsed = feeds.select(*keep, F.from_xml(clean_text(xml), FEED_SHAPE).alias("feed"))
    items = F.coalesce(F.col("feed.channel.item"), F.col("feed.item"))
    return _exploded(parsed.select(*keep, items.alias("items")), *keep)


def _exploded(feeds: DataFrame, *keep) -> DataFrame:
    return feeds.select(*keep, F.posexplode("items").alias("pos", "item")).select(
        *keep,
        F.col("pos").cast("long").alias("pos"),
        F.coalesce("item.title", F.lit("")).alias("title"),
        F.coalesce("item.link", F.lit("")).alias("link"),
    )


def _file_batch(infos, prefix):
    return pa.RecordBatch.from_arrays(
        [
            pa.array([prefix + i.path for i in infos], pa.string()),
            pa.array([i.mtime_ns // 1000 for i in infos], pa.timestamp("us", "UTC")),
            pa.array([i.size for i in infos], pa.int64()),
            pa.array([i.type == pafs.FileType.Directory for i in infos], pa.bool_()),
        ],
        names=["path", "modificationTime", "length", "folder"],
    )


def _prefix(root, name):
    return root.removesuffix(name) if root.endswith(name) else "file:"


def _shown(infos):
    return [i for i in infos if i.type == pafs.FileType.File and not i.base_name.startswith(("_", "."))]


def _list_top(roots):
    """Files and folders right below `roots`, without content too: the binary source would leave those out."""

    def run(batches):
        for _ in batches:
            for root in roots:
                fs, name = resolve(root)
                found = fs.get_file_info(name)
                infos = [found]
                if found.type == pafs.FileType.Directory:
                    infos = fs.get_file_info(pafs.FileSelector(name))
                infos = _shown(infos) + [i for i in infos if i.type == pafs.FileType.Directory]
                for first in range(0, len(infos), LISTED_ROWS):
                    yield _file_batch(infos[first : first + LISTED_ROWS], _prefix(root, name))

    return run


def _list_below():
    """The files as they are, and every file below the folders."""

    def run(batches):
        for batch in batches:
            folder = batch.column("folder").to_pylist()
            yield batch.filter(pa.array([not f for f in folder], pa.bool_())).select(_FILE_COLUMNS)
            for path in itertools.compress(batch.column("path").to_pylist(), folder):
                fs, name = resolve(path)
                infos = _shown(fs.get_file_info(pafs.FileSelector(name, recursive=True)))
                if infos:
                    yield _file_batch(infos, _prefix(path, name)).select(_FILE_COLUMNS)

    return run


def captures(spark: SparkSession, location: str, feed: Column | None = None) -> DataFrame:
    """Captured files at `location`, by name and time alone: `feed, path, modificationTime, length`.

    `location` is a file, a folder, or a pattern.  `feed` tells which feed a file (column
    `path`) is a capture of; all are of one without it.
    """
    of = F.lit("") if feed is None else feed
    filesystem, target = _hadoop(spark, location)
    roots = [status.getPath().toString() for status in filesystem.globStatus(target) or []]
    top = spark.range(1).repartition(1).mapInArrow(_list_top(roots), f"{FILE_SCHEMA}, folder boolean")
    tasks = SLICES_PER_CORE * spark.sparkContext.defaultParallelism
    files = top.repartition(tasks, "path").mapInArrow(_list_below(), FILE_SCHEMA)
    return files.select(of.alias("feed"), "path", "modificationTime", "length")


def _read_captures():
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                with open_for_read(row["path"]) as body:
                    data = body.read()
                verdict, lost, items = feedxml.read_bytes(data)
                held.append({**row, "verdict": verdict, "lost": lost, "items": items})
                size += len(data)
                if size >= READ_BYTES or len(held) >= LISTED_ROWS:
                    yield pa.RecordBatch.from_pylist(held, schema=_VERDICT_ARROW)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=_VERDICT_ARROW)

    return run


_VERDICT_ARROW = pa.schema([
    ("feed", pa.string()), ("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")),
    ("verdict", pa.string()), ("lost", pa.int32()),
    ("items", pa.list_(pa.struct([("title", pa.string()), ("link", pa.string())]))),
])


def judged(found: DataFrame) -> DataFrame:
    """The captures with what could be read of them: `verdict, lost, items`.

    `whole` and `partial` (cut off, or with items that cannot be told) have items;
    `empty` is a file without content and `foreign` one that is no feed.  A partial
    capture keeps its whole items and counts the others as `lost`.
    """
    # Small rows stand for files to read, so the tasks do not follow the bytes of the listing.
    tasks = SLICES_PER_CORE * found.sparkSession.sparkContext.defaultParallelism
    rows = found.select("feed", "path", "modificationTime").repartition(tasks, "path")
    return rows.mapInArrow(_read_captures(), VERDICT_SCHEMA)


def usable() -> Column:
    """Whether a capture tells what a feed lists: a cut one does if it holds items."""
    return (F.col("verdict") == feedxml.WHOLE) | (F.col("verdict") == feedxml.PARTIAL) & (F.size("items") > 0)


def latest_readable(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of each feed the newest capture that can be read, and the newer ones that cannot.

    Captures are read newest first (ties go by name), one for each feed and then some at
    a time, and only of feeds that are not settled: the older ones of a feed that lists
    its releases again and again are never opened.
    """
    order = Window.partitionBy("feed").orderBy(F.col("modificationTime").desc(), F.col("path").desc())
    ranked = materialise(found.withColumn("rank", F.row_number().over(order)), "captures")
    settled, skipped, first, size, open_feeds = [], [], 1, FIRST_ROUND, None
    while True:
        own = ranked.where(F.col("rank").between(first, first + size - 1))
        if open_feeds is not None:
            own = own.join(open_feeds, "feed", "left_semi")
        if own.isEmpty():
            break
        seen = materialise(judged(own), "verdicts").withColumn("usable", usable())
        newest = Window.partitionBy("feed").orderBy(F.col("modificationTime").desc(), F.col("path").desc())
        before = F.max(F.col("usable").cast("int")).over(newest.rowsBetween(Window.unboundedPreceding, -1))
        told = seen.withColumn("later", F.coalesce(before, F.lit(0)) == 0).where("later").drop("later")
        settled.append(told.where("usable").drop("usable"))
        skipped.append(told.where("not usable").drop("usable", "items"))
        open_feeds = materialise(
            own.select("feed").distinct().join(seen.where("usable"), "feed", "left_anti"), "open-feeds"
        )
        first, size = first + size, LATER_ROUNDS
    if not settled:
        none = found.sparkSession.createDataFrame([], VERDICT_SCHEMA)
        return none, none.drop("items")
    for frames in (settled, skipped):
        while len(frames) > 1:
            frames[0] = frames[0].unionByName(frames.pop())
    return settled[0], skipped[0]


def scan_feeds(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items `feed, feed_pos, title, link` of each feed's newest readable capture, and the skipped captures.

    A feed of which no capture can be read has no items; `latest_readable` tells them apart.
    """
    chosen, skipped = latest_readable(found)
    items = _exploded(chosen, "feed").withColumnRenamed("pos", "feed_pos")
    return items, skipped


def scan_feed(spark: SparkSession, location, kind: str) -> DataFrame:
    """Items of the newest readable capture of one release kind: `kind, feed_pos, title, link`.

    Earlier captures list the same releases again, so they are read only where the newest
    is broken; what was skipped goes to the log.  Without any readable capture the run fails.
    """
    found = captures(spark, location)
    if found.isEmpty():
        raise FileNotFoundError(f"no captured feed at {location}")
    chosen, skipped = latest_readable(found)
    unread = skipped.select("path", "verdict").limit(5).collect()
    if unread:
        log.warning("captures of %s skipped: %s", location, [tuple(row) for row in unread])
    if chosen.isEmpty():
        raise UnreadableFeed(f"no capture at {location} can be read, among them {[tuple(row) for row in unread]}")
    partial = chosen.where(F.col("verdict") == feedxml.PARTIAL).select("path", "lost").first()
    if partial:
        log.warning("%s is cut off or damaged; %s items are lost", *partial)
    return _exploded(chosen).select(
        F.lit(kind).alias("kind"), F.col("pos").alias("feed_pos"), "title", "link"
    )
