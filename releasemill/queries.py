"""Registered queries, each with the SQL that states its result.

The SQL works on the relational tables the inputs were made from, so it knows
nothing about feeds, archives, XML or workbooks: those have to be undone exactly
for the results to agree.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasemill import bindings as bind
from releasemill.functions import text as tx
from releasemill.functions import titles
from releasemill.model import RECORD_KEY, RENAMES, TARGET_SCHEMA, TITLE_PATTERNS
from releasemill.operators import catalog as cat
from releasemill.operators import frame as fr
from releasemill.operators import metrics, onefile, sinks
from releasemill.operators.published import PublishedTable
from releasemill.plans import ingest, runs
from releasemill.sources import archives as arc
from releasemill.sources import feed
from releasemill.sources.records import parse_payloads_native
from releasemill.streaming import landing
from releasemill.workspace import fresh_path

NOW = datetime(2026, 3, 26, 12, 34, 56)
STAMP = "yyyy-MM-dd HH:mm:ss"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql.strip()
        return function

    return register


# --- SQL pieces --------------------------------------------------------------------

SQL_KIND = {
    "daily": "'daily'", "weekly": "'weekly'", "monthly": "'monthly'", "full": "'full'",
    None: "CASE o_orderkey % 4 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' "
          "WHEN 2 THEN 'monthly' ELSE 'full' END",
}


def sql_catalog(kind: str | None = None) -> str:
    """CTEs ending in `cat`: the dated catalog straight from the order dates."""
    return f"""
WITH src AS (
  SELECT o_orderkey AS feed_pos, {SQL_KIND[kind]} AS kind,
         strftime(o_orderdate, '%Y%m%d') AS d, strftime(o_orderdate, '%Y%m') AS m,
         strftime(o_orderdate - INTERVAL 6 DAY, '%Y%m%d') AS s,
         CAST(o_orderdate AS DATE) AS day,
         CASE WHEN o_orderkey % 17 = 0 THEN 'notice'
              WHEN o_orderkey % 13 = 0 THEN 'bad' ELSE 'good' END AS state
  FROM orders),
cat AS (
  SELECT kind, feed_pos,
    CASE WHEN state = 'notice' THEN 'NOTICE_' || feed_pos
         WHEN kind = 'daily' THEN
           'UDID_DAY_UPDATE_' || CASE state WHEN 'bad' THEN '20261301' ELSE d END
         WHEN kind = 'weekly' THEN
           'UDID_WEEKLY_UPDATE_' || s || '_' || CASE state WHEN 'bad' THEN '20260230' ELSE d END
         WHEN kind = 'monthly' THEN
           'UDID_MONTH_UPDATE_' || CASE state WHEN 'bad' THEN '202613' ELSE m END
         WHEN state = 'bad' THEN 'UDID_FULL_RELEASE_20260100'
         ELSE 'x_UDID_FULL_RELEASE_' || d || '.zip' END AS title,
    'https://feed.example/' || feed_pos || '.zip' AS link,
    CASE WHEN state = 'notice' THEN NULL
         WHEN state = 'bad' THEN CASE kind WHEN 'daily' THEN '20261301' WHEN 'weekly' THEN '20260230'
                                  WHEN 'monthly' THEN '202613' ELSE '20260100' END
         WHEN kind = 'monthly' THEN m ELSE d END AS date_str,
    CASE WHEN state <> 'good' THEN NULL
         WHEN kind = 'monthly' THEN CAST(date_trunc('month', day) AS DATE) ELSE day END AS date,
    CASE WHEN kind = 'weekly' AND state <> 'notice' THEN
         s || '~' || CASE state WHEN 'bad' THEN '20260230' ELSE d END END AS period_str
  FROM src)
"""


SQL_TITLE = "'UDID_DAY_UPDATE_' || strftime(DATE '2026-01-01' + CAST({n} AS INTEGER), '%Y%m%d')"
SQL_WEEK = (
    "'UDID_WEEKLY_UPDATE_' || strftime(DATE '2026-01-01' + CAST({n} * 7 AS INTEGER), '%Y%m%d')"
    " || '_' || strftime(DATE '2026-01-01' + CAST({n} * 7 + 6 AS INTEGER), '%Y%m%d')"
)
SQL_FIELDS = '"deviceRecordKey", "prdName", "prdCode", "specModel", "orgName", unit, notes'

# `dev` holds the records, `doc` and `arc` the document and archive of each.
SQL_DEV = f"""
WITH placed AS (
  SELECT *, row_number() OVER (ORDER BY p_partkey NULLS LAST, p_name NULLS LAST,
    p_brand NULLS LAST, p_type NULLS LAST, p_size NULLS LAST) - 1 AS key FROM part),
dev AS (
  SELECT key, key // 25 AS doc, key // 500 AS arc,
    {SQL_TITLE.format(n='key // 500')} || '.zip' AS file_name,
    {SQL_WEEK.format(n='(key // 3500)')} || '.zip' AS week_name,
    'doc-' || lpad(CAST(key // 25 AS VARCHAR), 8, '0') AS doc_name,
    'day-' || lpad(CAST(key // 500 AS VARCHAR), 8, '0') || '.zip' AS day_name,
    CASE WHEN p_size % 10 <> 7 THEN 'K' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') END
      AS "deviceRecordKey",
    p_name || ' & <co>' AS "prdName", p_brand AS "prdCode", p_type AS "specModel",
    '器械' || p_brand AS "orgName", CAST(p_size AS VARCHAR) AS unit,
    CASE WHEN p_size % 6 = 0 THEN '' WHEN p_size % 2 = 0 THEN p_type END AS notes
  FROM placed),
xml AS (
  SELECT *, '<device>'
    || coalesce('<deviceRecordKey>' || "deviceRecordKey" || '</deviceRecordKey>', '')
    || '<prdName>' || replace("prdName", '<', '&lt;') || '</prdName>'
    || '<prdCode>' || "prdCode" || '</prdCode><specModel>' || "specModel" || '</specModel>'
    || '<orgName>' || chr(12288) || "orgName" || '&#160; </orgName>'
    || '<unit>' || chr(10) || '  ' || unit || '<!--size--></unit>'
    || coalesce('<notes>' || notes || '</notes>', '') || '</device>' AS body
  FROM dev)
"""
SQL_DOC_BYTES = (
    "CAST(sum(strlen(body)) + strlen('<?xml version=\"1.0\" encoding=\"utf-8\"?><r><devices>')"
    " + strlen('</devices></r>') AS BIGINT)"
)
# A workbook has no empty texts: a blank cell is a missing value.
SQL_MIXED_NOTES = "CASE WHEN doc % 4 = 1 THEN nullif(notes, '') ELSE notes END AS notes"
SQL_FIELDS_MIXED = (
    f'"deviceRecordKey", "prdName", "prdCode", "specModel", "orgName", unit, {SQL_MIXED_NOTES}'
)
SQL_FIELDS_FILE = (
    '"deviceRecordKey", "prdName", "prdCode", "specModel", "orgName", unit, '
    "nullif(notes, '') AS notes"
)

SQL_TARGET = """
  CAST(NULL AS VARCHAR) AS org_code, CAST(NULL AS VARCHAR) AS udi_di,
  CAST(NULL AS VARCHAR) AS udi_pi, CAST(NULL AS VARCHAR) AS prod_desc,
  CAST(NULL AS VARCHAR) AS spec_code, CAST(NULL AS VARCHAR) AS manage_class,
  CAST(NULL AS VARCHAR) AS device_class, CAST(NULL AS VARCHAR) AS apply_scope,
  CAST(NULL AS VARCHAR) AS reg_approval, CAST(NULL AS VARCHAR) AS expiry_date,
  CAST(NULL AS VARCHAR) AS storage_cond, CAST(NULL AS VARCHAR) AS contact_info,
  "deviceRecordKey" AS device_record_key, "prdCode" AS prd_code, "prdName" AS prd_name,
  "orgName" AS org_name, "specModel" AS spec_model, unit, notes,
  '20260101' AS data_date, 'daily_merged' AS source_file, 'daily' AS source_type,
  '' AS data_zip_file, '2026-03-26 12:34:56' AS download_time
"""


# --- Spark pieces --------------------------------------------------------------------


def scan(spark: SparkSession, sf: str, style: str) -> DataFrame:
    return arc.scan_archives(spark, bind.part_archives(spark, sf, style))


def bronze(spark: SparkSession, sf: str, style: str) -> ingest.Bronze:
    return ingest.read_bronze(scan(spark, sf, style), "skip")


def daily_catalog(spark, sf):
    return cat.build_catalog(bind.feed_rows(spark, sf, "daily"))


def mixed_catalog(spark, sf):
    return cat.build_catalog(bind.feed_rows(spark, sf))


def fields_frame(spark, sf):
    return bind.device_fields(bind.table(spark, sf, "part"))


def file_name():
    return F.element_at(F.split("archive", "/"), -1).alias("file_name")


def as_text(frame: DataFrame, *names) -> DataFrame:
    return frame.withColumns({n: F.date_format(n, STAMP) for n in names})


# --- sources -------------------------------------------------------------------------


@query("""
SELECT CASE WHEN o_orderkey % 19 = 0 THEN ''
            WHEN o_orderkey % 17 = 0 THEN 'NOTICE_' || o_orderkey
            WHEN o_orderkey % 13 = 0 THEN 'UDID_DAY_UPDATE_20261301'
            ELSE 'UDID_DAY_UPDATE_' || strftime(o_orderdate, '%Y%m%d') END AS title,
       'https://feed.example/' || o_orderkey || '.zip' AS link
FROM orders
""")
def feed_scan(spark, sf):
    return feed.feed_items(bind.feed_documents(spark, sf), F.col("feed")).select("title", "link")


@query(SQL_DEV + "SELECT DISTINCT file_name FROM dev")
def archive_scan(spark, sf):
    return scan(spark, sf, "plain").select("file_name")


@query(SQL_DEV + """,
docs AS (SELECT DISTINCT file_name, arc, doc, doc_name FROM dev),
named AS (
  SELECT file_name, arc, doc AS place, doc_name || CASE doc % 4 WHEN 1 THEN '.xlsx'
         WHEN 2 THEN '.zip' ELSE '.xml' END AS entry,
         CASE doc % 4 WHEN 1 THEN 'excel' WHEN 2 THEN 'zip' ELSE 'xml' END AS kind FROM docs
  UNION ALL SELECT DISTINCT file_name, arc, 1000000000000, 'readme.txt', NULL FROM docs
  UNION ALL SELECT DISTINCT file_name, arc, 1000000000001, 'UP.XML', NULL FROM docs)
SELECT file_name, entry, kind,
       row_number() OVER (PARTITION BY arc ORDER BY place) - 1 AS position FROM named
""")
def entry_manifest(spark, sf):
    manifest = arc.entry_manifest(arc.list_slices(scan(spark, sf, "mixed")))
    position = F.shiftright("entry_ord", 32).alias("position")
    return manifest.select(file_name(), "entry", "kind", position)


@query(SQL_DEV + """,
names AS (
  SELECT DISTINCT doc_name || CASE doc % 4 WHEN 1 THEN '.xlsx' WHEN 2 THEN '.zip'
         ELSE '.xml' END AS entry FROM dev
  UNION ALL SELECT DISTINCT 'readme.txt' FROM dev UNION ALL SELECT DISTINCT 'UP.XML' FROM dev)
SELECT entry, CASE WHEN ends_with(entry, '.zip') THEN 'zip' WHEN ends_with(entry, '.xml') THEN 'xml'
  ELSE 'excel' END AS kind FROM names
WHERE ends_with(entry, '.zip') OR ends_with(entry, '.xml') OR ends_with(entry, '.xls')
   OR ends_with(entry, '.xlsx')
""")
def entry_dispatch(spark, sf):
    manifest = arc.entry_manifest(arc.list_slices(scan(spark, sf, "mixed")))
    return manifest.select("entry", arc.kind_of(F.col("entry")).alias("kind")).filter(
        F.col("kind").isNotNull()
    )


@query(SQL_DEV + f"""
SELECT week_name AS file_name, day_name AS parent, doc_name || '.xml' AS entry,
       'xml' AS kind, {SQL_DOC_BYTES} AS size
FROM xml GROUP BY week_name, day_name, doc_name
""")
def nested_expand(spark, sf):
    payloads = arc.entry_payloads(arc.list_slices(scan(spark, sf, "weekly")))
    return payloads.select(
        file_name(), "parent", "entry", "kind",
        F.octet_length("payload").cast("long").alias("size"),
    )


SQL_SCAN = SQL_DEV + f"""
SELECT file_name, doc_name || '.xml' AS entry,
       row_number() OVER (PARTITION BY doc ORDER BY key) - 1 AS ord, {SQL_FIELDS} FROM dev
"""


@query(SQL_SCAN)
def xml_device_scan(spark, sf):
    records = bronze(spark, sf, "plain").records
    return records.select(
        file_name(), "entry", "ord", *[fr.field_column(records, n) for n in bind.PART_FIELDS]
    )


@query(SQL_SCAN)
def xml_device_scan_native(spark, sf):
    records = parse_payloads_native(arc.entry_payloads(arc.list_slices(scan(spark, sf, "plain"))))
    return records.filter("error is null").select(
        file_name(), "entry", "ord", *[F.col("fields")[n].alias(n) for n in bind.PART_FIELDS]
    )


@query(SQL_DEV + f"SELECT file_name, doc_name || '.xlsx' AS entry, {SQL_FIELDS_FILE} FROM dev")
def xlsx_device_scan(spark, sf):
    records = bronze(spark, sf, "sheets").records
    return records.select(
        file_name(), "entry", *[fr.field_column(records, n) for n in bind.PART_FIELDS]
    )


@query(SQL_DEV + "SELECT DISTINCT file_name, CAST(0 AS BIGINT) AS batch FROM dev")
def landing_stream(spark, sf):
    """Every archive arrives in the first run; the second run finds nothing new."""
    folder = bind.part_archives(spark, sf, "plain")
    seen, checkpoint = fresh_path(spark, "seen"), fresh_path(spark, "stream")

    def note(batch, batch_id):
        batch.select("file_name").write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")

    for _ in range(2):
        stream = landing.landing_stream(spark, folder, f"{checkpoint}-log")
        landing.run_available(stream, note, checkpoint)
    return spark.read.schema("file_name string, batch long").parquet(seen)


# --- text and scalar functions ----------------------------------------------------------


@F.pandas_udf(T.BinaryType())
def _gbk(text):
    return text.map(lambda t: t.encode("gbk"))


@query("SELECT p_partkey, '器械' || p_name AS name FROM part")
def charset_decode(spark, sf):
    """UTF-8, GBK and damaged UTF-8 in turn."""
    name = F.concat(F.lit("器械"), "p_name")
    data = (
        F.when(F.col("p_partkey") % 3 == 0, F.encode(name, "UTF-8"))
        .when(F.col("p_partkey") % 3 == 1, _gbk(name))
        .otherwise(F.concat(F.unhex(F.lit("FF")), F.encode(name, "UTF-8")))
    )
    raw = bind.table(spark, sf, "part").select("p_partkey", data.alias("data"))
    return raw.select("p_partkey", tx.decode_charset(F.col("data")).alias("name"))


@query(r"""
SELECT doc_id, regexp_replace(replace(text, 'e', 'e' || chr(2) || chr(31) || chr(9)),
                              '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g') AS text FROM documents
""")
def strip_control(spark, sf):
    dirty = F.replace(F.col("text"), F.lit("e"), F.lit("e\x02\x1f\t"))
    return bind.table(spark, sf, "documents").select("doc_id", tx.strip_controls(dirty).alias("text"))


@query("SELECT page_id, replace(html, '&nbsp;', ' ') AS html FROM pages")
def nbsp_replace(spark, sf):
    dirty = F.replace(F.col("html"), F.lit(" "), F.lit("&nbsp;"))
    return bind.table(spark, sf, "pages").select("page_id", tx.replace_nbsp(dirty).alias("html"))


SQL_ESCAPED = (
    "replace(replace(regexp_replace({0}, '&(amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);',"
    " chr(1) || '\\1;', 'g'), '&', '&amp;'), chr(1), '&')"
)


@query(f"SELECT page_id, {SQL_ESCAPED.format('html')} AS html FROM pages")
def amp_escape(spark, sf):
    return bind.table(spark, sf, "pages").select(
        "page_id", tx.escape_ampersands(F.col("html")).alias("html")
    )


SQL_CLEAN = SQL_ESCAPED.format(
    "replace(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g'), '&nbsp;', ' ')"
)


@query(f"SELECT doc_id, {SQL_CLEAN} AS clean FROM documents")
def xml_clean(spark, sf):
    """Damaged bytes in, repaired UTF-8 bytes out (shown as text)."""
    data = F.encode(F.replace(F.col("text"), F.lit("a"), F.lit("a\x08")), "UTF-8")
    damaged = F.when(F.col("doc_id") % 3 == 0, F.concat(data, F.unhex(F.lit("FF")))).otherwise(data)
    raw = bind.table(spark, sf, "documents").select("doc_id", damaged.alias("data"))
    repaired = F.encode(tx.clean_text(tx.decode_charset(F.col("data"))), "UTF-8")
    return raw.select("doc_id", F.decode(repaired, "UTF-8").alias("clean"))


@query("SELECT p_partkey, p_type AS name FROM part")
def local_tag(spark, sf):
    tag = F.when(
        F.col("p_partkey") % 2 == 0, F.concat(F.lit("{urn:"), "p_brand", F.lit("}"), "p_type")
    ).otherwise(F.col("p_type"))
    return bind.table(spark, sf, "part").select("p_partkey", tx.local_name(tag).alias("name"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '' ELSE
  trim(chr(12288) || chr(9) || ' ' || p_name || chr(160) || chr(8195) || chr(10),
       chr(9) || chr(10) || chr(13) || ' ' || chr(133) || chr(160) || chr(8195) || chr(12288))
  END AS name FROM part
""")
def unicode_strip(spark, sf):
    padded = F.concat(F.lit("　\t "), "p_name", F.lit("\xa0 \n"))
    blank = F.when(F.col("p_size") % 10 == 0, "　 ")
    name = F.when(F.col("p_size") % 5 == 0, blank).otherwise(padded)
    return bind.table(spark, sf, "part").select("p_partkey", tx.strip_text(name).alias("name"))


def _title_parse(kind):
    columns = ["feed_pos", "title", "date_str", "period_str"]
    sql = sql_catalog(kind) + f"SELECT {', '.join(columns)} FROM cat"

    @query(sql, name=f"title_parse_{kind}")
    def run(spark, sf):
        return cat.build_catalog(bind.feed_rows(spark, sf, kind)).select(*columns)


for _kind in TITLE_PATTERNS:
    _title_parse(_kind)


@query(sql_catalog() + "SELECT kind, feed_pos, date FROM cat")
def release_date_parse(spark, sf):
    return mixed_catalog(spark, sf).select("kind", "feed_pos", "date")


@query(sql_catalog("weekly") + "SELECT feed_pos, period_str FROM cat")
def period_label(spark, sf):
    rows = bind.feed_rows(spark, sf, "weekly")
    return rows.select(
        "feed_pos", titles.title_period(F.col("kind"), F.col("title")).alias("period_str")
    )


@query(sql_catalog() + """
SELECT kind, feed_pos, title, CASE WHEN date IS NULL THEN 'unknown' WHEN kind = 'weekly' THEN period_str
  WHEN kind = 'monthly' THEN strftime(date, '%Y-%m') ELSE strftime(date, '%Y-%m-%d') END AS label
FROM cat
""")
def catalog_listing(spark, sf):
    return cat.listing(mixed_catalog(spark, sf))


@query(sql_catalog() + """
SELECT feed_pos, coalesce(period_str, date_str, 'unknown') AS identifier FROM cat
""")
def release_identifier(spark, sf):
    return cat.with_identifier(mixed_catalog(spark, sf)).select("feed_pos", "identifier")


@query(sql_catalog() + """
SELECT feed_pos, 'udid_' || kind || '_' || coalesce(period_str, date_str, 'unknown')
  || '_20260326_123456.csv' AS name FROM cat
""")
def output_name(spark, sf):
    named = cat.with_identifier(mixed_catalog(spark, sf))
    name = titles.output_name(
        F.col("kind"), F.col("identifier"), F.lit(str(NOW)).cast("timestamp"), F.lit("csv")
    )
    return named.select("feed_pos", name.alias("name"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_retailprice END AS price,
       CASE WHEN p_size % 2 = 0 THEN '' ELSE p_name END AS name FROM part
""")
def nan_to_null(spark, sf):
    return fr.nan_to_null(
        bind.table(spark, sf, "part").select(
            "p_partkey",
            F.when(F.col("p_size") % 3 == 0, float("nan")).otherwise(F.col("p_retailprice")).alias("price"),
            F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_name")).alias("name"),
        )
    )


# --- projections and schema ---------------------------------------------------------------


@query(SQL_DEV + f"""
SELECT {SQL_FIELDS}, 'prdName' || CASE WHEN "deviceRecordKey" IS NULL THEN '' ELSE ',deviceRecordKey' END
  || ',prdCode,specModel,orgName,unit' || CASE WHEN notes IS NULL THEN '' ELSE ',notes' END AS layout
FROM dev
""")
def record_extract(spark, sf):
    """Repeated and nested children, comments and childless devices."""
    records = bronze(spark, sf, "quirky").records
    return records.select(
        F.translate("layout", fr.LAYOUT_SEP, ",").alias("layout"),
        *[fr.field_column(records, n) for n in bind.PART_FIELDS],
    )


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev")
def widen_records(spark, sf):
    """Columns found in the data alone: no field is known beforehand."""
    parsed = ingest.read_bronze(scan(spark, sf, "plain"), columns=())
    return fr.drop_lineage(fr.widen(parsed.records))


@query(SQL_DEV + f"""
SELECT "deviceRecordKey" AS device_record_key, "prdName" AS prd_name, "prdCode" AS prd_code,
       "specModel" AS spec_model, "orgName" AS org_name, unit, notes, unit || 'x' AS "extraField" FROM dev
""")
def rename_columns(spark, sf):
    extra = F.concat("unit", F.lit("x"))
    return fr.rename_columns(fields_frame(spark, sf).withColumn("extraField", extra))


@query(SQL_DEV + f"""
SELECT {SQL_FIELDS}, '20260101' AS data_date, '' AS data_zip_file, 'daily_merged' AS source_file,
       'daily' AS source_type, '2026-03-26 12:34:56' AS download_time FROM dev
""")
def add_lineage(spark, sf):
    frame = fr.add_lineage(
        fields_frame(spark, sf), data_date="20260101", now=_now(), kind="daily"
    )
    return as_text(frame, "download_time")


def _now():
    return F.lit(str(NOW)).cast("timestamp")


def target_rows(spark, sf):
    frame = fr.rename_columns(fields_frame(spark, sf).withColumn("extraField", F.lit("x")))
    return fr.target_projection(
        fr.add_lineage(frame, data_date="20260101", now=_now(), kind="daily")
    )


@query(SQL_DEV + f"SELECT {SQL_TARGET} FROM dev")
def target_projection(spark, sf):
    return as_text(target_rows(spark, sf), "download_time")


# --- catalog filters and order ----------------------------------------------------------------


CATALOG_COLUMNS = "kind, feed_pos, title, link, date_str, date, period_str"
SQL_ORDER = "ORDER BY date DESC NULLS LAST, feed_pos"


@query(sql_catalog() + f"SELECT {CATALOG_COLUMNS} FROM cat")
def catalog_all(spark, sf):
    return mixed_catalog(spark, sf)


@query(sql_catalog("daily") + f"""
SELECT {CATALOG_COLUMNS} FROM cat WHERE date_str = '19970528' {SQL_ORDER} LIMIT 1
""")
def find_release(spark, sf):
    return cat.find_by_date(daily_catalog(spark, sf), "19970528")


@query(sql_catalog() + f"SELECT {CATALOG_COLUMNS} FROM cat {SQL_ORDER} LIMIT 1 OFFSET 24")
def release_by_ordinal(spark, sf):
    return cat.by_ordinal(mixed_catalog(spark, sf), 25)


@query(sql_catalog() + f"SELECT {CATALOG_COLUMNS} FROM cat WHERE date_str IS NOT NULL")
def dated_releases(spark, sf):
    return cat.dated(mixed_catalog(spark, sf))


@query(sql_catalog() + f"""
SELECT {CATALOG_COLUMNS}, row_number() OVER ({SQL_ORDER}) AS position FROM cat
""")
def catalog_sorted(spark, sf):
    return fr.with_position(mixed_catalog(spark, sf), cat.catalog_order(), "position")


@query(sql_catalog() + f"SELECT {CATALOG_COLUMNS} FROM cat {SQL_ORDER} LIMIT 1")
def latest_release(spark, sf):
    return cat.latest(mixed_catalog(spark, sf))


@query(SQL_DEV + f"""
SELECT {SQL_FIELDS_MIXED},
       row_number() OVER (ORDER BY "deviceRecordKey" NULLS LAST, key) AS position FROM dev
""")
def sorted_records(spark, sf):
    parsed = bronze(spark, sf, "mixed")
    wide = fr.widen(parsed.records)
    numbered = fr.with_position(wide, fr.record_order(wide), "position", parsed.slices.bytes)
    return fr.drop_lineage(numbered)


# --- unions -----------------------------------------------------------------------------------


@query(SQL_DEV + """
SELECT "deviceRecordKey", "prdName" FROM dev UNION ALL BY NAME
SELECT notes, "deviceRecordKey" FROM dev UNION ALL BY NAME SELECT unit FROM dev
""")
def union_by_name(spark, sf):
    rows = fields_frame(spark, sf)
    return fr.union_by_name(
        rows.select(RECORD_KEY, "prdName"), rows.select("notes", RECORD_KEY), rows.select("unit")
    )


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev UNION ALL SELECT {SQL_FIELDS} FROM dev")
def all_releases_union(spark, sf):
    """Daily and weekly releases of the same days: duplicates stay."""
    archives = scan(spark, sf, "plain").unionByName(scan(spark, sf, "weekly"))
    return ingest.ingest_release(archives)


@query(SQL_DEV + f"SELECT {SQL_FIELDS_FILE} FROM dev")
def full_release_rows(spark, sf):
    """A snapshot written as CSV parts under one header, read back."""
    frame = ingest.ingest_full(scan(spark, sf, "mixed"))
    path = sinks.write_csv(frame, fresh_path(spark, "full-csv"))
    return sinks.read_csv(spark, path, frame.schema)


@query(SQL_DEV + f"""
SELECT {SQL_FIELDS_FILE}, row_number() OVER (ORDER BY "deviceRecordKey" NULLS LAST, key) - 1 AS line FROM dev
""")
def single_csv(spark, sf):
    """Sorted records as one file under one header, put together from small pieces, with their lines."""
    parsed = bronze(spark, sf, "plain")
    frame = ingest.merged_frame(parsed).select(*bind.PART_FIELDS)
    path = onefile.write_csv_file(frame, fresh_path(spark, "single-csv"), piece_bytes=1 << 14)
    # One file of quoted text is read in order, in one piece.
    return sinks.read_csv(spark, path, frame.schema).withColumn("line", F.monotonically_increasing_id())


# --- counts -------------------------------------------------------------------------------------


@query("SELECT count(*) AS records FROM part")
def record_count(spark, sf):
    return metrics.record_count(bronze(spark, sf, "mixed").records)


@query(SQL_DEV + """
SELECT file_name, count(*) AS records FROM dev GROUP BY file_name UNION ALL
SELECT DISTINCT replace(file_name, '.zip', '_torn.zip'), 0 FROM dev WHERE arc % 3 = 1
""")
def archive_counts(spark, sf):
    """Records that can be read per archive, damaged ones included."""
    archives = scan(spark, sf, "faulty")
    parsed = ingest.read_bronze(archives, "skip")
    return metrics.archive_counts(parsed.rows, archives).select(file_name(), "records")


@query(sql_catalog("weekly") + """,
daily AS (SELECT min(CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '20261301'
                     ELSE strftime(o_orderdate, '%Y%m%d') END) AS low FROM orders)
SELECT 'weekly' AS kind, min(date_str) || '~' || max(date_str) AS identifier FROM cat
UNION ALL SELECT 'daily', low FROM daily
UNION ALL SELECT 'none', 'all'
""")
def range_identifier(spark, sf):
    weekly = cat.build_catalog(bind.feed_rows(spark, sf, "weekly"))
    daily = daily_catalog(spark, sf)
    none = daily.filter(F.col("date_str").isNull())
    labelled = [("weekly", weekly, "weekly"), ("daily", daily, "daily"), ("none", none, "daily")]
    return fr.union_by_name(
        *[
            metrics.range_identifier(frame, kind).select(F.lit(name).alias("kind"), "identifier")
            for name, frame, kind in labelled
        ]
    )


@query(SQL_DEV + f""",
docs AS (SELECT file_name, doc, {SQL_DOC_BYTES} AS size FROM xml GROUP BY file_name, doc)
SELECT file_name, CAST(sum(size) AS BIGINT) AS total_bytes, count(*) AS entries
FROM docs GROUP BY file_name
""")
def archive_bytes(spark, sf):
    manifest = arc.entry_manifest(arc.list_slices(scan(spark, sf, "plain")))
    return metrics.archive_bytes(manifest).select(file_name(), "total_bytes", "entries")


@query(SQL_DEV + """
SELECT file_name, count(DISTINCT CASE WHEN doc % 4 IN (0, 3) THEN doc END) AS xml_entries,
       count(DISTINCT CASE WHEN doc % 4 IN (1, 2) THEN doc END) AS other_entries
FROM dev GROUP BY file_name
""")
def entry_distribution(spark, sf):
    manifest = arc.entry_manifest(arc.list_slices(scan(spark, sf, "mixed")))
    return metrics.entry_distribution(manifest).select(
        file_name(), "xml_entries", "other_entries"
    )


SQL_FAILURES = """
SELECT DISTINCT file_name, 'zz-broken.xml' AS entry, false AS fatal FROM dev
UNION ALL SELECT DISTINCT file_name, 'zz-torn.zip', true FROM dev WHERE arc % 3 = 2
UNION ALL SELECT DISTINCT replace(file_name, '.zip', '_torn.zip'), NULL, true FROM dev WHERE arc % 3 = 1
"""


@query(SQL_DEV + f", bad AS ({SQL_FAILURES}) SELECT count(*) AS failures FROM bad")
def failure_count(spark, sf):
    return metrics.failure_count(bronze(spark, sf, "faulty").rows)


@query("SELECT count(*) AS releases FROM orders")
def catalog_count(spark, sf):
    return metrics.catalog_count(mixed_catalog(spark, sf))


# --- sinks ----------------------------------------------------------------------------------------


@query("""
SELECT doc_id, nullif(' ' || text || '"', '') AS padded, nullif(text, '') AS text,
       CASE WHEN doc_id % 2 = 0 THEN NULL ELSE lang || ',\\' END AS lang FROM documents
""")
def csv_roundtrip(spark, sf):
    frame = bind.table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit(" "), "text", F.lit('"')).alias("padded"),
        "text",
        F.when(F.col("doc_id") % 4 == 0, "")
        .when(F.col("doc_id") % 2 == 1, F.concat("lang", F.lit(",\\")))
        .alias("lang"),
    )
    path = sinks.write_csv(frame, fresh_path(spark, "csv"))
    return sinks.read_csv(spark, path, frame.schema)


@query("""
SELECT CASE WHEN count(*) > 1000 THEN 'csv' ELSE 'excel' END AS format FROM part
""")
def format_route(spark, sf):
    return sinks.format_route(bind.table(spark, sf, "part"), "excel", guard=1000)


@query(SQL_DEV + f"SELECT {SQL_FIELDS_FILE} FROM dev")
def excel_roundtrip(spark, sf):
    """Workbook parts written from records, packed up again and read back."""
    path = sinks.write_excel(fields_frame(spark, sf), fresh_path(spark, "excel"), guard=400)
    books = arc.scan_archives(spark, bind.wrap_files(spark, path))
    parsed = ingest.read_bronze(books)
    return fr.drop_lineage(fr.widen(parsed.records))


@query(SQL_DEV + f"SELECT {SQL_TARGET}, '2026-03-26 12:34:56' AS create_time FROM dev")
def create_time_default(spark, sf):
    """The rows a JDBC write sends: target columns and the insertion time."""
    frame = fr.with_create_time(target_rows(spark, sf), _now())
    return as_text(frame, "download_time", "create_time")


@query(SQL_DEV + f"SELECT {SQL_TARGET} FROM dev UNION ALL SELECT {SQL_TARGET} FROM dev")
def table_append(spark, sf):
    """Two appends by column name, the second with its columns in another order."""
    location = fresh_path(spark, "table")
    table = f"{sinks.TARGET_TABLE}_{location.rsplit('-', 1)[1]}"
    sinks.create_table(spark, table, location)
    rows = target_rows(spark, sf)
    sinks.write_table(rows, table)
    sinks.write_table(rows.select(*reversed(TARGET_SCHEMA.names)), table)
    return as_text(spark.table(table), "download_time")


@query(SQL_DEV + f"SELECT {SQL_FIELDS_FILE} FROM dev")
def sink_fallback(spark, sf):
    """The database refuses the rows, so they go to a file."""
    frame, path = fields_frame(spark, sf), fresh_path(spark, "fallback")
    sinks.save_with_fallback(
        frame,
        lambda staged: sinks.write_jdbc(staged, "jdbc:absent://nowhere"),
        lambda staged: sinks.save_file(staged, path),
    )
    return sinks.read_csv(spark, path, frame.schema)


# --- whole ingests ----------------------------------------------------------------------------------


@query(SQL_DEV + f"SELECT {SQL_FIELDS_MIXED} FROM dev")
def ingest_release(spark, sf):
    return ingest.ingest_release(scan(spark, sf, "mixed"))


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev WHERE arc = (SELECT max(arc) FROM dev)")
def ingest_latest(spark, sf):
    catalog = cat.build_catalog(bind.release_rows(spark, sf))
    return ingest.ingest_latest(catalog, scan(spark, sf, "plain"))


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev WHERE arc % 3 <> 2")
def ingest_all(spark, sf):
    catalog = cat.build_catalog(bind.release_rows(spark, sf))
    return ingest.ingest_all(catalog, scan(spark, sf, "faulty")).frame


@query("""
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS "deviceRecordKey",
       CAST(l_partkey AS VARCHAR) AS "prdCode", '器械 ' || l_suppkey AS "orgName",
       l_returnflag AS "manageClass", l_linestatus AS "deviceClass",
       CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS notes,
       strftime(l_shipdate, '%Y-%m-%d') AS "expiryDate"
FROM lineitem
""")
def ingest_full(spark, sf):
    return ingest.ingest_full(arc.scan_archives(spark, bind.line_archives(spark, sf)))


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev")
def weekly_rollup(spark, sf):
    return ingest.ingest_release(scan(spark, sf, "weekly"))


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev")
def incremental_ingest(spark, sf):
    """Two runs over one landing folder; nothing is ingested twice."""
    folder = bind.part_archives(spark, sf, "plain")
    target, checkpoint = fresh_path(spark, "devices"), fresh_path(spark, "stream")
    for _ in range(2):
        landing.ingest_incremental(spark, folder, target, checkpoint)
    return spark.read.parquet(target).select(*bind.PART_FIELDS)


@query(SQL_DEV + SQL_FAILURES)
def dead_letter(spark, sf):
    return bronze(spark, sf, "faulty").dead_letter.select(file_name(), "entry", "fatal")


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev WHERE arc % 3 <> 2")
def bad_release_skipped(spark, sf):
    return ingest.ingest_release(scan(spark, sf, "faulty"), "skip")


# --- the paths for large inputs ---------------------------------------------------------------------

# Far below the sizes at which these paths are usually taken.
SMALL_LIMITS = arc.Limits(
    nested_bytes=1000, split_document_bytes=2000, document_bytes=1500, held_document_bytes=1800,
    segment_chars=1200,
)


@query(SQL_DEV + f"""
SELECT {SQL_FIELDS_FILE}, count(*) * 160 AS copies FROM dev
WHERE key // 125 % 2 = 0 GROUP BY ALL
""")
def whole_workbooks(spark, sf):
    """Workbooks of 20,000 rows, every second one broken in its last: those give nothing."""
    archives = arc.scan_archives(spark, bind.part_archives(spark, sf, "torn sheets"))
    frame = fr.drop_lineage(fr.widen(ingest.read_bronze(archives).records, list(bind.PART_FIELDS)))
    return frame.groupBy(*bind.PART_FIELDS).agg(F.count("*").alias("copies"))


@query(SQL_SCAN)
def xml_device_scan_segmented(spark, sf):
    """The same rows, places included, where each document is cut up and parsed by many tasks."""
    read = ingest.read_bronze(scan(spark, sf, "plain"), limits=SMALL_LIMITS)
    return read.records.select(
        file_name(), "entry", "ord", *[fr.field_column(read.records, n).alias(n) for n in bind.PART_FIELDS]
    )


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev")
def weekly_rollup_unpacked(spark, sf):
    """Deflated nested archives above the split size: each is inflated once and listed."""
    return ingest.merged_frame(ingest.read_bronze(scan(spark, sf, "weekly"), limits=SMALL_LIMITS))


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev")
def completed_archives(spark, sf):
    """A first run sees archives that are empty or cut short, the second sees them whole."""
    source = bind.part_archives(spark, sf, "plain")
    folder, target, checkpoint = (fresh_path(spark, n) for n in ("landing", "devices", "stream"))
    for whole in (False, True):
        bind.land(spark, source, folder, whole)
        landing.ingest_incremental(spark, folder, target, checkpoint)
    return spark.read.parquet(target).select(*bind.PART_FIELDS)


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev WHERE arc = (SELECT max(arc) FROM dev)")
def latest_by_kind(spark, sf):
    """Another kind's archives of the same names, and links with a query string."""
    catalog = cat.build_catalog(
        bind.release_rows(spark, sf).withColumn("link", F.concat("link", F.lit("?token=9#top")))
    )
    daily = scan(spark, sf, "plain").withColumn("kind", F.lit("daily"))
    weekly = scan(spark, sf, "quirky").withColumn("kind", F.lit("weekly"))
    return ingest.ingest_latest(catalog, daily.unionByName(weekly))


# Pages of a hundred orders; the item of a page that its newest capture has cut or damaged
# is lost, and where that capture has no items at all the one before counts.
SQL_PAGES = """
WITH numbered AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders),
paged AS (SELECT *, place // 100 AS page, place % 100 AS feed_pos,
                 count(*) OVER (PARTITION BY place // 100) AS items FROM numbered),
kept AS (
  SELECT *, page % 5 IN (1, 2) OR items = 1 AND page % 5 = 0 AS from_old FROM paged
  WHERE NOT (page % 5 = 0 AND items > 1 AND feed_pos = items - 1 OR page % 5 = 3 AND feed_pos = 0))
SELECT page, feed_pos - CASE WHEN page % 5 = 3 THEN 1 ELSE 0 END AS feed_pos,
       CASE WHEN from_old THEN 'old ' ELSE '' END
       || CASE WHEN o_orderkey % 17 = 0 THEN 'NOTICE_' || o_orderkey
               WHEN o_orderkey % 13 = 0 THEN 'UDID_DAY_UPDATE_20261301'
               ELSE 'UDID_DAY_UPDATE_' || strftime(o_orderdate, '%Y%m%d') END AS title,
       'https://feed.example/' || o_orderkey || '.zip' AS link
FROM kept
"""


def _capture_page(path):
    return F.regexp_extract(path, "page=([0-9]+)", 1)


@query(SQL_PAGES)
def newest_capture(spark, sf):
    """Two captures of every page of the feed: the older one must not repeat its releases, unless the newer is broken."""
    found = feed.captures(spark, bind.feed_captures(spark, sf), _capture_page(F.col("path")))
    items, _ = feed.scan_feeds(found)
    return items.select(F.col("feed").cast("long").alias("page"), "feed_pos", "title", "link")


@query("""
WITH pages AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS page FROM orders),
sized AS (SELECT page, count(*) AS items FROM pages GROUP BY page)
SELECT page, CASE page % 5 WHEN 0 THEN 'partial' WHEN 1 THEN 'empty' WHEN 2 THEN 'foreign' WHEN 3 THEN 'partial'
  ELSE 'whole' END AS verdict, CAST(CASE WHEN page % 5 IN (0, 3) THEN 1 ELSE 0 END AS INTEGER) AS lost,
  CAST(CASE WHEN page % 5 IN (1, 2) THEN 0 WHEN page % 5 IN (0, 3) THEN items - 1 ELSE items END AS INTEGER) AS items
FROM sized
""")
def capture_verdicts(spark, sf):
    """What the newest capture of every page is worth."""
    found = feed.captures(spark, bind.feed_captures(spark, sf), _capture_page(F.col("path")))
    read = feed.judged(found.where(F.col("path").endswith("/2.xml")))
    return read.select(F.col("feed").cast("long").alias("page"), "verdict", "lost", F.size("items").alias("items"))


@query(SQL_DEV + f"""
SELECT "deviceRecordKey" AS device_record_key, "prdName" AS prd_name, "prdCode" AS prd_code,
       "specModel" AS spec_model, "orgName" AS org_name, unit, notes, '20260326' AS data_date,
       'daily' AS source_type FROM (SELECT {SQL_FIELDS_MIXED} FROM dev)
""")
def delivered_release(spark, sf):
    """A release of mixed entries, saved to a table by the one plan and read back."""
    path = fresh_path(spark, "delivered")
    report = ingest.save_release(
        scan(spark, sf, "mixed"), kind="daily", identifier="20260326", now=NOW,
        write_database=lambda rows: rows.write.parquet(path),
    )
    assert report["target"] == "database"
    names = ("device_record_key", "prd_name", "prd_code", "spec_model", "org_name", "unit", "notes",
             "data_date", "source_type")
    return spark.read.parquet(path).select(*names)


@query(SQL_DEV + f""", bad AS ({SQL_FAILURES})
SELECT 'daily' AS kind, count(*) AS records, (SELECT count(*) FROM bad) AS failures, 'database' AS target,
       count(*) AS written FROM dev WHERE arc % 3 <> 2
""")
def run_report(spark, sf):
    """The report of a run over archives of which some are torn, beside the rows it wrote."""
    path = fresh_path(spark, "reported")
    report = ingest.save_release(
        scan(spark, sf, "faulty"), kind="daily", identifier="20260326", now=NOW, on_bad_archive="skip",
        write_database=lambda rows: rows.write.parquet(path),
    )
    names = ("kind", "records", "failures", "target")
    made = spark.createDataFrame(
        [tuple(report[n] for n in names)], "kind string, records long, failures long, target string"
    )
    return made.withColumn("written", F.lit(spark.read.parquet(path).count()).cast("long"))


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev")
def saved_callback(spark, sf):
    """What the callback after a save is given: the frame as it was saved."""
    path = fresh_path(spark, "called")
    ingest.save_release(
        scan(spark, sf, "plain"), kind="full", identifier="20260326", now=NOW,
        folder=fresh_path(spark, "saved"), on_saved=lambda frame: frame.write.parquet(path),
    )
    return spark.read.parquet(path).select(
        *[F.col(RENAMES.get(n, n)).alias(n) for n in bind.PART_FIELDS]
    )


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev WHERE arc % 3 <> 2")
def resumed_ingest(spark, sf):
    """All releases over three runs: a first that sees a half of them, one that repeats it, and one that finds nothing new."""
    catalog, path = cat.build_catalog(bind.release_rows(spark, sf)), fresh_path(spark, "ledger")
    landed = scan(spark, sf, "faulty")
    early = landed.where(F.pmod(F.xxhash64("file_name"), F.lit(2)) == 0)
    for archives in (early, landed, landed):
        runs.ingest_remaining(catalog, archives, path)
    return runs.Ledger(spark, path).frame()


@query(SQL_DEV + """,
docs AS (SELECT DISTINCT file_name, arc FROM dev)
SELECT file_name, arc % 3 <> 2 AS ok, CAST(CASE WHEN arc % 3 = 2 THEN 2 ELSE 1 END AS BIGINT) AS runs FROM docs
""")
def release_ledger(spark, sf):
    """What the runs note of each release: one that could not be read is tried again by every run."""
    catalog, path = cat.build_catalog(bind.release_rows(spark, sf)), fresh_path(spark, "ledger")
    for _ in range(2):
        runs.ingest_remaining(catalog, scan(spark, sf, "faulty"), path)
    states = runs.Ledger(spark, path).releases()
    return states.groupBy(file_name()).agg(F.bool_or("ok").alias("ok"), F.count("*").alias("runs"))


@query(SQL_DEV + f"SELECT {SQL_TARGET} FROM dev")
def published_append(spark, sf):
    """Target rows appended by one run, repeated, and by a run that fails half-way."""
    table = PublishedTable(spark, fresh_path(spark, "published"))
    rows = target_rows(spark, sf)
    torn = rows.withColumn("unit", F.when(F.col("prd_name").isNotNull(), F.raise_error(F.lit("torn"))))
    for run, frame in (("a", rows), ("a", rows), ("b", torn)):
        try:
            table.append(run, {"devices": frame})
        except Exception as error:
            if "torn" not in str(error):
                raise
    return as_text(table.read("devices", TARGET_SCHEMA), "download_time")


@query(SQL_DEV + f"SELECT * REPLACE (nullif(notes, '') AS notes) FROM (SELECT {SQL_TARGET} FROM dev)")
def table_append_text(spark, sf):
    """Rows of the target table in a table of tab-separated text."""
    location = fresh_path(spark, "table")
    table = f"{sinks.TARGET_TABLE}_{location.rsplit('-', 1)[1]}"
    sinks.create_table(spark, table, location, "text")
    sinks.write_table(target_rows(spark, sf), table)
    rows = spark.table(table)
    # Text cannot tell empty from missing; the notes alone hold empty ones.
    return as_text(rows.withColumn("data_zip_file", F.coalesce("data_zip_file", F.lit(""))), "download_time")


@query(SQL_DEV + f"SELECT {SQL_FIELDS} FROM dev")
def promoted_stream(spark, sf):
    """Three batches of a stream that knows the key alone: all other fields become columns of its table."""
    target, known = fresh_path(spark, "promoted"), ("deviceRecordKey",)
    archives, third = scan(spark, sf, "plain"), F.pmod(F.xxhash64("file_name"), F.lit(3))
    for batch in range(3):
        landing.append_records(target, known, promote=True)(archives.where(third == batch), batch)
    return landing.read_records(spark, target, known).select(*bind.PART_FIELDS)


@query(SQL_DEV + f"SELECT {SQL_FIELDS_MIXED} FROM dev")
def entries_by_place(spark, sf):
    """Every entry that has records (documents, workbooks, nested ones), read again by its place."""
    archives = scan(spark, sf, "mixed")
    places = ingest.read_bronze(archives).records.select("archive", "release_ord", "entry_ord").distinct()
    again = ingest.read_entries(archives, places).records
    return again.select(*[fr.field_column(again, n).alias(n) for n in bind.PART_FIELDS])


@query(SQL_DEV + """
SELECT DISTINCT file_name, 'zz-broken.xml' AS entry, CAST(2 AS BIGINT) AS replays FROM dev WHERE arc % 3 <> 2
""")
def replayed_failures(spark, sf):
    """Entries of the releases read so far that two replays could not read either."""
    catalog, path = cat.build_catalog(bind.release_rows(spark, sf)), fresh_path(spark, "ledger")
    landed = scan(spark, sf, "faulty")
    runs.ingest_remaining(catalog, landed, path)
    for _ in range(2):
        runs.replay_failures(catalog, landed, path)
    ledger = runs.Ledger(spark, path)
    tried = ledger.table.read("replays", runs.REPLAYS).groupBy(*runs.PLACE).agg(F.count("*").alias("replays"))
    return ledger.open_failures().join(tried, runs.PLACE).select(file_name(), "entry", "replays")
