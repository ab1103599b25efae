"""CSV, workbook, JDBC and table sinks, and the choice between them."""

from __future__ import annotations

import itertools
import logging
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from releasemill.model import (
    EXCEL_ROW_GUARD,
    JDBC_BATCH_ROWS,
    TARGET_COLUMNS,
    TARGET_SCHEMA,
    TARGET_TABLE,
)
from releasemill.sources.sheetwriter import write_workbook
from releasemill.sources.storage import publish
from releasemill.workspace import exists, materialise, qualified

log = logging.getLogger(__name__)

# Connections that tasks open to a database at once.
JDBC_CONNECTIONS = 16

# Spark trims values and escapes with backslashes unless told otherwise.
CSV_OPTIONS = {
    "header": True,
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def output_name(kind: str, identifier: str, now, extension: str) -> str:
    return f"udid_{kind}_{identifier}_{now:%Y%m%d_%H%M%S}.{extension}"


def _flat(frame: DataFrame) -> DataFrame:
    """Map columns as JSON text."""
    maps = [f.name for f in frame.schema if isinstance(f.dataType, MapType)]
    return frame.withColumns({name: F.to_json(F.col(f"`{name}`")) for name in maps})


def write_csv(frame: DataFrame, path: str, head: bool = True) -> str:
    """Comma-separated part files, each with the header (`head`); blank for NULL and empty.

    In a frame of one column a blank is quoted: an empty line would be no row.
    """
    options, frame = CSV_OPTIONS | {"header": head}, _flat(frame)
    if len(frame.columns) == 1:
        name = frame.columns[0]
        frame = frame.select(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(name))
        options["emptyValue"] = '""'
    frame.write.options(**options).csv(path)
    return path


def read_csv(spark, path: str, schema) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS, multiLine=True).schema(schema).csv(path)


def _workbook_parts(path, names, guard):
    def run(batches):
        rows = (row.values() for batch in batches for row in batch.to_pylist())
        task = TaskContext.get().partitionId()
        for number in itertools.count():
            part = list(itertools.islice(rows, 1))
            if not part:
                return
            chunk = itertools.chain(part, itertools.islice(rows, guard - 1))
            target = f"{path}/part-{task:05d}-{number:05d}.xlsx"
            written = 0

            def counted(chunk=chunk):
                nonlocal written
                for row in chunk:
                    written += 1
                    yield row

            publish(target, lambda out: write_workbook(out, names, counted()))
            yield pa.RecordBatch.from_pylist([{"path": target, "rows": written}])

    return run


def write_excel(frame: DataFrame, path: str, guard: int = EXCEL_ROW_GUARD) -> str:
    """Workbooks, one or more per partition, none above the row guard.

    An existing folder is refused, like the CSV sink does: it would mix two runs.
    """
    if exists(frame.sparkSession, path):
        raise FileExistsError(f"{path} exists already")
    frame = _flat(frame)
    text = frame.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in frame.columns])
    parts = text.mapInArrow(
        _workbook_parts(qualified(frame.sparkSession, path), list(frame.columns), guard),
        "path string, rows long",
    )
    parts.agg(F.sum("rows")).first()
    return path


def format_route(frame: DataFrame, requested: str, guard: int = EXCEL_ROW_GUARD) -> DataFrame:
    """One row `format`: `csv` where a workbook was asked for but rows exceed its guard."""
    above = F.count("*") > guard
    return frame.agg(
        F.when((F.lit(requested) == "excel") & above, "csv").otherwise(requested).alias("format")
    )


def route_format(frame: DataFrame, requested: str, guard: int = EXCEL_ROW_GUARD) -> str:
    if requested != "excel":
        return requested
    return format_route(frame, requested, guard).first()["format"]


def target_column_types() -> str:
    """Column types of the relational target table."""
    return ", ".join(
        f"{name} VARCHAR({length})" if length else f"{name} TIMESTAMP"
        for name, length in TARGET_COLUMNS
    )


def jdbc_writer(frame: DataFrame, url: str, table: str, **options):
    """Writer of `frame` to a table, over a bounded number of connections."""
    types = target_column_types()
    if "create_time" in frame.columns:
        types += ", create_time TIMESTAMP"
    fixed = {
        "url": url, "dbtable": table, "batchsize": JDBC_BATCH_ROWS,
        "numPartitions": JDBC_CONNECTIONS, "createTableColumnTypes": types,
    }
    return frame.write.format("jdbc").options(**(fixed | options))


def jdbc_statements(frame: DataFrame, table: str, staging: str) -> tuple[list[str], list[str]]:
    """What moves the staged rows: one transaction, and what clears up afterwards."""
    columns = ", ".join(frame.columns)
    return (
        [f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging}"],
        [f"DROP TABLE {staging}"],
    )


def run_statements(spark, url: str, statements, options, transaction: bool) -> None:
    """Run statements over one connection of the driver, all or none in a transaction."""
    jvm = spark.sparkContext._jvm
    if "driver" in options:
        jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(options["driver"])
    settings = jvm.java.util.Properties()
    for name, value in options.items():
        settings.setProperty(name, str(value))
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(not transaction)
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
        if transaction:
            connection.commit()
    finally:
        connection.close()


def write_jdbc(frame: DataFrame, url: str, table: str = TARGET_TABLE, execute=run_statements,
               **options) -> None:
    """Append by column name, whole or not at all.

    Tasks, which commit on their own, fill a staging table; one statement then
    moves its rows into the target.  The empty append before creates a target that
    does not exist.
    """
    spark = frame.sparkSession
    staging = f"{table}_stage_{uuid.uuid4().hex[:8]}"
    jdbc_writer(frame.limit(0), url, table, **options).mode("append").save()
    move, clear = jdbc_statements(frame, table, staging)
    try:
        jdbc_writer(frame, url, staging, **options).mode("errorifexists").save()
        execute(spark, url, move, options, True)
    finally:
        try:
            execute(spark, url, clear, options, False)
        except Exception:  # the rows' fate is decided; a leftover table harms nobody
            log.warning("staging table %s was not dropped", staging, exc_info=True)


def create_table(spark, table: str, location: str | None = None, storage: str = "parquet") -> None:
    """The declared target table; `storage="text"` keeps tab-separated text."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TARGET_SCHEMA)
    using = "USING csv OPTIONS (sep '\\t')" if storage == "text" else f"USING {storage}"
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) {using}{place}")


def write_table(frame: DataFrame, table: str) -> None:
    frame.sparkSession.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=frame)


def save_file(frame: DataFrame, path: str, requested: str = "csv",
              guard: int = EXCEL_ROW_GUARD, on_saved=None, one_file: bool = False) -> str:
    """Write a file output, then call `on_saved(frame)`, whose errors do not matter.

    CSV is a folder of parts, or with `one_file` one file under one header.  Returns the
    format written, which is CSV where a workbook has too few rows.
    """
    from releasemill.operators.onefile import write_csv_file

    written = route_format(frame, requested, guard)
    if written == "excel":
        write_excel(frame, path, guard)
    else:
        (write_csv_file if one_file else write_csv)(frame, path)
    if on_saved is not None:
        try:
            on_saved(frame)
        except Exception:
            log.warning("data callback failed", exc_info=True)
    return written


def save_with_fallback(frame: DataFrame, write_database, write_file) -> str:
    """`database` when that write succeeds, else `file`.

    Either write takes the staged frame, so the file holds the same rows the
    database refused.  Without a database writer the frame goes straight to file.
    """
    if write_database is None:
        write_file(frame)
        return "file"
    staged = materialise(frame, "staged")
    try:
        write_database(staged)
        return "database"
    except Exception as error:
        reason = str(error).partition("\n")[0]
        log.warning("database write failed, writing a file instead: %s", reason)
    write_file(staged)
    return "file"
