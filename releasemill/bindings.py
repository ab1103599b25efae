"""Registry-shaped inputs made from TPC-H-like tables.

The engine reads captured feeds and ZIP archives.  To exercise it on relational
test tables, rows of `orders` become feed items and rows of `part` or
`lineitem` become device records, packed into archives by Spark tasks.  All
sizes grow with the tables: documents and archives hold a fixed number of rows.
"""

from __future__ import annotations

import io
import itertools
import math
import shutil
import zipfile

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from releasemill.model import KINDS
from releasemill.operators.frame import with_position
from releasemill.sources.sheetwriter import EPOCH, write_workbook
from releasemill.sources.storage import open_for_read, publish
from releasemill.workspace import exists, fresh_path

DOCUMENT_RECORDS = 25
ARCHIVE_RECORDS = 500
WEEK_RECORDS = 7 * ARCHIVE_RECORDS
# Rows of `part` in a workbook of the torn-sheet style, and how often each is written.
SHEET_RECORDS = 125
SHEET_COPIES = 160
FIRST_DAY = "2026-01-01"

PART_FIELDS = ("deviceRecordKey", "prdName", "prdCode", "specModel", "orgName", "unit", "notes")

# Files written by a task: archives, captured pages.
TASK_FILES = 64
TASK_CAPTURES = 1024

LINE_DOCUMENT_RECORDS = 1000
LINE_ARCHIVE_RECORDS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- catalog from orders ---------------------------------------------------------


def feed_rows(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    """Feed items `kind, feed_pos, title, link`, one per order.

    Without `kind` the kinds alternate.  Some titles match no pattern, some
    hold impossible dates.
    """
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    start = F.date_format(F.date_sub("o_orderdate", 6), "yyyyMMdd")
    month = F.date_format("o_orderdate", "yyyyMM")
    good = {
        "daily": F.concat(F.lit("UDID_DAY_UPDATE_"), day),
        "weekly": F.concat(F.lit("UDID_WEEKLY_UPDATE_"), start, F.lit("_"), day),
        "monthly": F.concat(F.lit("UDID_MONTH_UPDATE_"), month),
        "full": F.concat(F.lit("x_UDID_FULL_RELEASE_"), day, F.lit(".zip")),
    }
    bad = {
        "daily": F.lit("UDID_DAY_UPDATE_20261301"),
        "weekly": F.concat(F.lit("UDID_WEEKLY_UPDATE_"), start, F.lit("_20260230")),
        "monthly": F.lit("UDID_MONTH_UPDATE_202613"),
        "full": F.lit("UDID_FULL_RELEASE_20260100"),
    }

    kinds = [kind] if kind else KINDS

    def pick(values):
        """The value of the row's kind; only that one is computed."""
        chain = values[kinds[-1]]
        for number, name in enumerate(kinds[:-1]):
            chain = F.when(key % len(kinds) == number, values[name]).otherwise(chain)
        return chain

    return table(spark, sf_dir, "orders").select(
        pick({name: F.lit(name) for name in kinds}).alias("kind"),
        key.alias("feed_pos"),
        F.when(key % 17 == 0, F.concat(F.lit("NOTICE_"), key))
        .when(key % 13 == 0, pick(bad))
        .otherwise(pick(good))
        .alias("title"),
        F.concat(F.lit("https://feed.example/"), key, F.lit(".zip")).alias("link"),
    )


def feed_documents(spark: SparkSession, sf_dir: str, page: int = 100) -> DataFrame:
    """Feed documents `feed` of at most `page` items each; some items lack a title."""
    rows = feed_rows(spark, sf_dir, "daily")
    title = F.when(
        F.col("feed_pos") % 19 != 0, F.concat(F.lit("<title>"), "title", F.lit("</title>"))
    )
    item = F.concat(
        F.lit("<item>"), F.coalesce(title, F.lit("")), F.lit("<link>"), "link",
        F.lit("</link></item>"),
    )
    # Pages are runs of rows, so their size does not depend on any key.
    numbered = rows.select(
        F.expr(f"monotonically_increasing_id() div {page}").alias("page"), item.alias("item")
    )
    return numbered.groupBy("page").agg(
        F.concat(
            F.lit('<?xml version="1.0"?><rss version="2.0"><channel>'),
            F.array_join(F.collect_list("item"), ""),
            F.lit("</channel></rss>"),
        ).alias("feed")
    ).select("feed")


CAPTURE_ITEMS = 100


def _write_captures(folder, later):
    """Files of each page: first a good capture, then, if `later`, one that is not whole.

    Pages take turns: cut in their last item, without content, an error page, an item
    without its end, and a whole capture again, of other titles.
    """

    def run(batches):
        written = []
        rows = (row for batch in batches for row in batch.to_pylist())
        for page, group in itertools.groupby(rows, lambda r: r["page"]):
            items = [
                f"<item><title>{'old ' if not later else ''}{r['title']}</title><link>{r['link']}</link></item>"
                for r in group
            ]
            body = '<?xml version="1.0"?><rss version="2.0"><channel><title>all</title>' + "".join(items)
            whole = f"{body}</channel></rss>"
            fate = page % 5
            if later:
                whole = (
                    body[:-12], "", "<!DOCTYPE html><html><body><p>502</body></html>",
                    whole.replace("</item>", "", 1), whole,
                )[fate]
            path = f"{folder}/page={page}/{'2' if later else '1'}.xml"
            publish(path, lambda out, data=whole.encode(): out.write(data))
            written.append({"path": path})
            if len(written) >= 1000:
                yield pa.RecordBatch.from_pylist(written)
                written = []
        if written:
            yield pa.RecordBatch.from_pylist(written)

    return run


def feed_captures(spark: SparkSession, sf_dir: str) -> str:
    """Folder of two captures for every hundred orders; the second of most is broken."""
    folder = fresh_path(spark, "captures")
    rows = with_position(feed_rows(spark, sf_dir, "daily"), [F.col("feed_pos").asc()], "position")
    paged = rows.withColumn("page", F.expr(f"(position - 1) div {CAPTURE_ITEMS}"))
    tasks = pack_tasks(spark, table(spark, sf_dir, "orders").count(), CAPTURE_ITEMS, TASK_CAPTURES)
    for later in (False, True):
        (
            paged.repartition(tasks, "page").sortWithinPartitions("page", "position")
            .mapInArrow(_write_captures(folder, later), "path string").count()
        )
    return folder


# --- device records from part ------------------------------------------------------


def _element(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


def _optional(name: str, value: Column) -> Column:
    return F.coalesce(_element(name, value), F.lit(""))


def placed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` numbered from 0 in key order, as column `place`.

    Documents and archives are runs of these numbers, so their size is fixed
    even if many rows were to share a key.
    """
    names = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
    order = [F.col(name).asc_nulls_last() for name in names]
    numbered = with_position(table(spark, sf_dir, "part").select(*names), order, "position")
    return numbered.withColumn("place", F.col("position") - 1).drop("position")


def device_fields(parts: DataFrame, *keep) -> DataFrame:
    """Device fields of rows of `part`."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return parts.select(
        *keep,
        F.when(size % 10 != 7, F.concat(F.lit("K"), F.lpad(key.cast("string"), 12, "0"))).alias(
            "deviceRecordKey"
        ),
        F.concat("p_name", F.lit(" & <co>")).alias("prdName"),
        F.col("p_brand").alias("prdCode"),
        F.col("p_type").alias("specModel"),
        F.concat(F.lit("器械"), "p_brand").alias("orgName"),
        size.cast("string").alias("unit"),
        F.when(size % 6 == 0, "").when(size % 2 == 0, F.col("p_type")).alias("notes"),
    )


def device_xml(quirks: bool) -> Column:
    """XML of a device record."""
    # The ampersand stays bare: repairing it is the engine's job.
    name = F.replace(F.col("prdName"), F.lit("<"), F.lit("&lt;"))
    model = F.col("specModel")
    if quirks:
        model = F.concat(model, F.lit("<i>deep</i>tail"))
    return F.concat(
        F.lit("<device/><device><prdName>stale</prdName>" if quirks else "<device>"),
        _optional("deviceRecordKey", F.col("deviceRecordKey")),
        _element("prdName", name),
        _element("prdCode", F.col("prdCode")),
        _element("specModel", model),
        _element("orgName", F.concat(F.lit("\u3000"), "orgName", F.lit("&#160; "))),
        _element("unit", F.concat(F.lit("\n  "), "unit", F.lit("<!--size-->"))),
        _optional("notes", F.col("notes")),
        F.lit("</device>"),
    )


def release_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed items of the daily archives packed from `part`."""
    archives = math.ceil(table(spark, sf_dir, "part").count() / ARCHIVE_RECORDS)
    title = daily_title(F.col("id"))
    dated = spark.range(archives).select(
        F.lit("daily").alias("kind"),
        F.col("id").alias("feed_pos"),
        title.alias("title"),
        F.concat(F.lit("https://feed.example/"), title, F.lit(".zip")).alias("link"),
    )
    # A notice without date points at the same file; it must not be ingested again.
    notices = dated.withColumn("title", F.concat(F.lit("NOTICE_"), "feed_pos"))
    return dated.unionByName(notices)


def daily_title(number: Column) -> Column:
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), number.cast("int"))
    return F.concat(F.lit("UDID_DAY_UPDATE_"), F.date_format(day, "yyyyMMdd"))


def weekly_title(number: Column) -> Column:
    start = F.date_add(F.lit(FIRST_DAY).cast("date"), (number * 7).cast("int"))
    return F.concat(
        F.lit("UDID_WEEKLY_UPDATE_"), F.date_format(start, "yyyyMMdd"), F.lit("_"),
        F.date_format(F.date_add(start, 6), "yyyyMMdd"),
    )


# --- packing (task side) -----------------------------------------------------------


def _info(name):
    info = zipfile.ZipInfo(name, EPOCH)
    info.compress_type = zipfile.ZIP_DEFLATED
    return info


def _write_document(zf, name, records, charset="utf-8"):
    records = iter(records)
    with zf.open(_info(name), "w") as body:
        body.write(f'<?xml version="1.0" encoding="{charset}"?><r><devices>'.encode())
        while block := list(itertools.islice(records, 1000)):
            body.write("".join(record["xml"] for record in block).encode(charset))
        body.write(b"</devices></r>")


def _nested(name, records):
    """A ZIP holding one document, and one more ZIP that is too deep to count."""
    deep = io.BytesIO()
    with zipfile.ZipFile(deep, "w") as zf:
        _write_document(zf, "deep.xml", [{"xml": "<device><unit>deep</unit></device>"}])
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as zf:
        _write_document(zf, f"{name}.xml", records)
        zf.writestr(_info("deep.zip"), deep.getvalue())
    return buffer.getvalue()


def _documents(records):
    for number, group in itertools.groupby(records, lambda r: r["place"] // DOCUMENT_RECORDS):
        yield number, f"doc-{number:08d}", group


def _write_plain(zf, records):
    for _, name, group in _documents(records):
        _write_document(zf, f"{name}.xml", group)


def _write_mixed(zf, records):
    """Documents as XML, workbook, nested ZIP and GBK in turn, and files to ignore."""
    for number, name, group in _documents(records):
        if number % 4 == 1:
            buffer = io.BytesIO()
            write_workbook(buffer, PART_FIELDS, ([r[f] for f in PART_FIELDS] for r in group))
            zf.writestr(_info(f"{name}.xlsx"), buffer.getvalue())
        elif number % 4 == 2:
            zf.writestr(_info(f"{name}.zip"), _nested(name, group))
        else:
            _write_document(zf, f"{name}.xml", group, "gbk" if number % 4 == 3 else "utf-8")
    zf.writestr(_info("readme.txt"), "not data")
    _write_document(zf, "UP.XML", [{"xml": "<device><unit>up</unit></device>"}])


def _write_sheets(zf, records):
    for _, name, group in _documents(records):
        buffer = io.BytesIO()
        write_workbook(buffer, PART_FIELDS, ([r[f] for f in PART_FIELDS] for r in group))
        zf.writestr(_info(f"{name}.xlsx"), buffer.getvalue())


def _write_weekly(zf, records):
    for number, day in itertools.groupby(records, lambda r: r["place"] // ARCHIVE_RECORDS):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as inner:
            _write_plain(inner, day)
        zf.writestr(_info(f"day-{number:08d}.zip"), buffer.getvalue())


def _write_faulty(zf, records):
    """Every archive has a truncated document, every third a torn nested archive."""
    first = next(records)
    _write_plain(zf, itertools.chain([first], records))
    zf.writestr(_info("zz-broken.xml"), "<r><devices><device><unit>1</unit>")
    if first["place"] // ARCHIVE_RECORDS % 3 == 2:
        zf.writestr(_info("zz-torn.zip"), b"PK\x03\x04 torn")


def _write_torn_sheets(zf, records):
    """Every second workbook of an archive breaks in its last row."""
    for number, group in itertools.groupby(records, lambda r: r["place"] // SHEET_RECORDS):
        rows = ([r[f] for f in PART_FIELDS] for r in group)
        buffer = io.BytesIO()
        # Many copies of the rows make a workbook of several blocks.
        write_workbook(buffer, PART_FIELDS, rows, SHEET_COPIES, TORN_ROW if number % 2 else b"")
        # Large and much alike: the fastest level takes a fifth of the time of the usual one.
        zf.writestr(_info(f"sheet-{number:08d}.xlsx"), buffer.getvalue(), compresslevel=1)


# A cell that refers to no string.
TORN_ROW = b'<row><c t="s"><v>99999999</v></c></row>'


# style -> (writer, quirks in the XML, records per archive)
STYLES = {
    "plain": (_write_plain, False, ARCHIVE_RECORDS),
    "quirky": (_write_plain, True, ARCHIVE_RECORDS),
    "mixed": (_write_mixed, False, ARCHIVE_RECORDS),
    "sheets": (_write_sheets, False, ARCHIVE_RECORDS),
    "faulty": (_write_faulty, False, ARCHIVE_RECORDS),
    "weekly": (_write_weekly, False, WEEK_RECORDS),
    "torn sheets": (_write_torn_sheets, False, ARCHIVE_RECORDS),
}


def _pack(folder, style):
    writer = STYLES[style][0]

    def run(batches):
        rows = (row for batch in batches for row in batch.to_pylist())
        for (number, title), records in itertools.groupby(
            rows, lambda r: (r["archive_no"], r["title"])
        ):
            path = f"{folder}/{title}.zip"

            def write(out, records=records):
                with zipfile.ZipFile(out, "w") as zf:
                    writer(zf, records)

            publish(path, write)
            if style == "faulty" and number % 3 == 1:
                publish(f"{folder}/{title}_torn.zip", lambda out: out.write(b"no zip"))
            yield pa.RecordBatch.from_pylist([{"path": path}])

    return run


def pack_tasks(spark: SparkSession, rows: int, size: int, task_files: int = TASK_FILES) -> int:
    """Tasks that pack `rows` into files of `size` rows: enough for all cores, a bounded number of files each."""
    files = max(1, math.ceil(rows / size))
    return min(files, max(math.ceil(files / task_files), 4 * spark.sparkContext.defaultParallelism))


_PACKED: dict[tuple, str] = {}


def _packed(spark: SparkSession, sf_dir: str, style: str, pack) -> str:
    """Folder that `pack(folder)` fills; kept for the application while it exists."""
    memo = (spark.sparkContext.applicationId, sf_dir, style)
    if memo not in _PACKED or not exists(spark, _PACKED[memo]):
        folder = fresh_path(spark, style.replace(" ", "-"))
        pack(folder)
        _PACKED[memo] = folder
    return _PACKED[memo]


def part_archives(spark: SparkSession, sf_dir: str, style: str) -> str:
    """Folder of archives made from `part`."""
    _, quirks, size = STYLES[style]

    def pack(folder):
        number = F.expr(f"place div {size}")
        title = weekly_title(number) if style == "weekly" else daily_title(number)
        placed = device_fields(placed_parts(spark, sf_dir), "place").withColumns(
            {"xml": device_xml(quirks), "archive_no": number, "title": title}
        )
        # Rows are small beside the work on them, so the tasks follow the archives.
        (
            placed.repartition(pack_tasks(spark, table(spark, sf_dir, "part").count(), size), "archive_no")
            .sortWithinPartitions("archive_no", "place")
            .mapInArrow(_pack(folder, style), "path string")
            .count()
        )

    return _packed(spark, sf_dir, style, pack)


# --- full snapshot from lineitem -----------------------------------------------------


LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
                "l_extendedprice", "l_shipdate")


def dealt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` dealt out evenly, about an archive to each task.

    The few columns are shuffled, not the documents made of them, and by the hash of a row
    number: dealing in turn would sort all rows before, and spill.
    """
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    # By hash some tasks get a little more than others; an archive has room for that.
    tasks = math.ceil(lines.count() / (0.98 * LINE_ARCHIVE_RECORDS))
    numbered = lines.withColumn("_row", F.monotonically_increasing_id())
    return numbered.repartition(max(1, tasks), "_row").drop("_row")


def line_fields(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
            "deviceRecordKey"
        ),
        F.col("l_partkey").cast("string").alias("prdCode"),
        F.concat(F.lit("器械 "), F.col("l_suppkey").cast("string")).alias("orgName"),
        F.col("l_returnflag").alias("manageClass"),
        F.col("l_linestatus").alias("deviceClass"),
        F.round(F.col("l_extendedprice") * 100).cast("long").cast("string").alias("notes"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("expiryDate"),
    )


def _pack_lines(folder):
    def run(batches):
        rows = ({"xml": x} for batch in batches for x in batch.column(0).to_pylist())
        task = TaskContext.get().partitionId()
        for number in itertools.count():
            first = next(rows, None)
            if first is None:
                return
            records = itertools.chain([first], itertools.islice(rows, LINE_ARCHIVE_RECORDS - 1))

            def write(out, records=records):
                with zipfile.ZipFile(out, "w") as zf:
                    for document in itertools.count():
                        head = next(records, None)
                        if head is None:
                            return
                        body = itertools.islice(records, LINE_DOCUMENT_RECORDS - 1)
                        _write_document(
                            zf, f"doc-{document:05d}.xml", itertools.chain([head], body)
                        )

            path = f"{folder}/UDID_FULL_RELEASE_20260301_{task:05d}_{number:05d}.zip"
            publish(path, write)
            yield pa.RecordBatch.from_pylist([{"path": path}])

    return run


def line_archives(spark: SparkSession, sf_dir: str) -> str:
    """Folder of snapshot archives made from `lineitem`, dealt out evenly over tasks."""

    def pack(folder):
        fields = line_fields(dealt_lines(spark, sf_dir))
        xml = F.concat(
            F.lit("<device>"),
            *[_element(name, F.col(name)) for name in fields.columns],
            F.lit("</device>"),
        )
        fields.select(xml.alias("xml")).mapInArrow(
            _pack_lines(folder), "path string"
        ).count()

    return _packed(spark, sf_dir, "lines", pack)


def _wrap(folder):
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                leaf = path.rpartition("/")[2]

                def write(out, path=path, leaf=leaf):
                    with open_for_read(path) as body, zipfile.ZipFile(out, "w") as zf:
                        with zf.open(_info(leaf), "w") as entry:
                            shutil.copyfileobj(body, entry)

                target = f"{folder}/{leaf}.zip"
                publish(target, write)
                yield pa.RecordBatch.from_pylist([{"path": target}])

    return run


def wrap_files(spark: SparkSession, location: str, glob: str = "*.xlsx") -> str:
    """Folder with one archive around each file of `location`."""
    folder = fresh_path(spark, "wrapped")
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(location)
    files.select("path").mapInArrow(_wrap(folder), "path string").count()
    return folder


def _land(folder, whole):
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                leaf = path.rpartition("/")[2]
                with open_for_read(path) as body:
                    data = body.read()
                fate = sum(leaf.encode()) % 3
                if not whole:
                    data = (data, data[: len(data) // 2], b"")[fate]
                if not whole or fate:
                    publish(f"{folder}/{leaf}", lambda out, data=data: out.write(data))
                yield pa.RecordBatch.from_pylist([{"path": leaf}])

    return run


def land(spark: SparkSession, source: str, folder: str, whole: bool) -> None:
    """Copy archives to a landing folder; if not `whole`, a third is cut short, a third empty.

    A second, whole run replaces just those.
    """
    files = spark.read.format("binaryFile").load(source).select("path")
    files.mapInArrow(_land(folder, whole), "path string").count()
