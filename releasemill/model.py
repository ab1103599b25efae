"""Schemas and fixed values shared by every stage."""

from pyspark.sql import types as T

# --- fixed values (must equal the published registry conventions) ----------

KINDS = ("daily", "weekly", "monthly", "full")

# One title pattern per release kind.  They are searched, not anchored.
TITLE_PATTERNS = {
    "daily": r"UDID_DAY_UPDATE_(\d{8})",
    "weekly": r"UDID_WEEKLY_UPDATE_(\d{8})_(\d{8})",
    "monthly": r"UDID_MONTH_UPDATE_(\d{6})",
    "full": r"UDID_FULL_RELEASE_(\d{8})",
}

RECORD_KEY = "deviceRecordKey"
TARGET_TABLE = "udi_device_data"

# Source field -> target column, target length.
DEVICE_COLUMNS = (
    ("deviceRecordKey", "device_record_key", 100),
    ("prdCode", "prd_code", 100),
    ("prdName", "prd_name", 500),
    ("orgName", "org_name", 500),
    ("orgCode", "org_code", 100),
    ("udiDI", "udi_di", 100),
    ("udiPI", "udi_pi", 200),
    ("prodDesc", "prod_desc", 1000),
    ("specModel", "spec_model", 200),
    ("unit", "unit", 50),
    ("specCode", "spec_code", 100),
    ("manageClass", "manage_class", 50),
    ("deviceClass", "device_class", 50),
    ("applyScope", "apply_scope", 500),
    ("regApproval", "reg_approval", 100),
    ("expiryDate", "expiry_date", 50),
    ("storageCond", "storage_cond", 200),
    ("contactInfo", "contact_info", 200),
    ("notes", "notes", 500),
)

# Target table in declared order; None marks a timestamp.
TARGET_COLUMNS = (
    ("data_date", 20),
    ("source_file", 200),
    ("source_type", 20),
    ("device_record_key", 100),
    ("data_zip_file", 200),
    ("download_time", None),
) + tuple((target, length) for _, target, length in DEVICE_COLUMNS[1:])

# Cell texts a spreadsheet reader takes for a missing value (pandas defaults).
SHEET_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# What str.strip() removes.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Batch size and row guard of the sinks.
JDBC_BATCH_ROWS = 1000
EXCEL_ROW_GUARD = 1_000_000

# --- derived -----------------------------------------------------------------

RENAMES = {source: target for source, target, _ in DEVICE_COLUMNS}
KNOWN_FIELDS = tuple(source for source, _, _ in DEVICE_COLUMNS)

TARGET_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType() if length else T.TimestampType())
        for name, length in TARGET_COLUMNS
    ]
)

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("feed_pos", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("date_str", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("period_str", T.StringType()),
    ]
)

# Where one entry sits inside the file it is read from.
ENTRY_STRUCT = T.StructType(
    [
        T.StructField("entry", T.StringType()),
        T.StructField("parent", T.StringType()),
        T.StructField("entry_ord", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("packed", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("method", T.IntegerType()),
        T.StructField("flags", T.IntegerType()),
        T.StructField("crc", T.LongType()),
    ]
)

# A slice is a run of neighbouring entries of one archive: the unit of work.
SLICE_SCHEMA = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("release_ord", T.LongType()),
        T.StructField("slice_no", T.LongType()),
        T.StructField("slice_bytes", T.LongType()),
        T.StructField("nested_bytes", T.LongType()),
        T.StructField("entries", T.ArrayType(ENTRY_STRUCT)),
        # Where the entries are read from, if not from the archive itself.
        T.StructField("file", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

LINEAGE = ("release_ord", "archive", "entry_ord", "ord")

_lineage_fields = [
    T.StructField("archive", T.StringType()),
    T.StructField("release_ord", T.LongType()),
    T.StructField("parent", T.StringType()),
    T.StructField("entry", T.StringType()),
    T.StructField("entry_ord", T.LongType()),
    T.StructField("ord", T.LongType()),
    T.StructField("layout", T.StringType()),
]
_error_fields = [
    T.StructField("error", T.StringType()),
    T.StructField("fatal", T.BooleanType()),
]

# `layout` holds the record's field names in order, joined by LAYOUT_SEP.
LAYOUT_SEP = "\x1f"
FIELDS_TYPE = T.MapType(T.StringType(), T.StringType())

BRONZE_SCHEMA = T.StructType(
    _lineage_fields + [T.StructField("fields", FIELDS_TYPE)] + _error_fields
)


def wide_bronze_schema(columns):
    """Bronze with some fields as columns of their own; `fields` keeps the rest."""
    return T.StructType(
        _lineage_fields
        + [T.StructField(name, T.StringType()) for name in columns]
        + [T.StructField("fields", FIELDS_TYPE)]
        + _error_fields
    )


PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("entry", T.StringType()),
        T.StructField("parent", T.StringType()),
        T.StructField("entry_ord", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)
