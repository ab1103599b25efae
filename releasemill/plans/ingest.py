"""From landed archives to record frames."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from releasemill.model import KNOWN_FIELDS
from releasemill.operators import catalog as cat
from releasemill.operators import frame as fr
from releasemill.operators import metrics, sinks
from releasemill.sources.archives import Limits, Slices, chosen_entries, entry_manifest, list_slices
from releasemill.sources.records import parse_slices_counted
from releasemill.workspace import release, small_side


class BadArchive(Exception):
    """A release archive cannot be read."""


class NotLanded(Exception):
    """The archive of a release asked for is not there."""


@dataclass
class Bronze:
    """Parsed archives: written once, read column by column from then on."""

    slices: Slices
    rows: DataFrame
    bad_archives: DataFrame | None
    counts: dict[str, int] | None = None  # of `rows`, if their write has taken them

    def record_count(self) -> int:
        """Number of `records`."""
        if self.counts and self.bad_archives is None:
            return self.counts["records"]
        return self.records.count()

    def failure_count(self) -> int:
        return self.counts["failures"] if self.counts else metrics.failure_count(self.rows).first()["failures"]

    @property
    def records(self) -> DataFrame:
        """Records of every archive that could be read in full."""
        return self.without_bad(fr.good_records(self.rows))

    @property
    def dead_letter(self) -> DataFrame:
        return metrics.dead_letter(self.rows)

    def release(self) -> None:
        """Delete the tables behind these rows; nothing can be read from them any more."""
        release(self.rows)
        release(self.slices.frame)

    def without_bad(self, frame: DataFrame) -> DataFrame:
        if self.bad_archives is None:
            return frame
        return frame.join(self.bad_archives, "archive", "left_anti")


def read_bronze(archives: DataFrame, on_bad_archive: str = "fail",
                columns=KNOWN_FIELDS, limits: Limits | None = None) -> Bronze:
    """Parse archives once.

    An entry that does not parse is skipped and kept as a failure row.  An
    archive that cannot be read raises, or with `on_bad_archive="skip"` gives
    no records at all.  `columns` are stored as columns of their own.
    """
    slices = list_slices(archives, limits)
    rows, counts = parse_slices_counted(slices, columns)
    fatal = rows.filter("fatal")
    failures = counts["fatal"] if counts else fatal.count()
    if failures == 0:
        return Bronze(slices, rows, None, counts)
    if on_bad_archive == "fail":
        shown = fatal.select("archive", "entry", "error").limit(5).collect()
        raise BadArchive(f"{failures} unreadable archives or entries, among them {shown}")
    bad = fatal.select("archive").distinct()
    return Bronze(slices, rows, small_side(bad, failures), counts)


def read_entries(archives: DataFrame, places: DataFrame, columns=KNOWN_FIELDS,
                 limits: Limits | None = None) -> Bronze:
    """Parse the entries at `places` (`archive, release_ord, entry_ord`, each once) and no others.

    Of the archives only the directories are read besides.  An archive that can no longer be
    read gives no records; a place without an entry gives nothing.
    """
    wanted = archives.join(places.select("archive").distinct(), "archive", "left_semi")
    listed = list_slices(wanted, limits)
    chosen = chosen_entries(listed, places)
    rows, counts = parse_slices_counted(chosen, columns)
    bad = rows.filter("fatal").select("archive").distinct()
    return Bronze(chosen, rows, small_side(bad, bad.count()), counts)


def merged_frame(bronze: Bronze, sort: bool = True, fields=None, lineage=False) -> DataFrame:
    """All records as one frame: union by name, then ordered by record key.

    With `lineage` the place of origin stays, in columns that begin with `_`.
    """
    wide = fr.widen(bronze.records, fields)
    if sort:
        wide = fr.sort_records(wide, bronze.slices.bytes)
    return wide if lineage else fr.drop_lineage(wide)


def ingest_release(archives: DataFrame, on_bad_archive: str = "fail") -> DataFrame:
    return merged_frame(read_bronze(archives, on_bad_archive))


def ingest_full(archives: DataFrame, on_bad_archive: str = "fail") -> DataFrame:
    """A snapshot: same records, in no particular order, so no sort shuffle."""
    return merged_frame(read_bronze(archives, on_bad_archive), sort=False)


def ingest_latest(catalog: DataFrame, archives: DataFrame) -> DataFrame:
    """The newest release; it must have landed, as one archive.

    A snapshot is left unsorted, like `ingest_full` does.
    """
    wanted = cat.latest(catalog).collect()
    if not wanted:
        raise NotLanded("the catalog is empty")
    chosen = catalog.sparkSession.createDataFrame(wanted, catalog.schema)
    located = cat.locate(chosen, archives)
    cat.require_one_each(located)
    if located.isEmpty():
        raise NotLanded(f"no archive for {wanted[0]['title']!r}, {wanted[0]['link']!r}")
    return merged_frame(read_bronze(located), sort=wanted[0]["kind"] != "full")


@dataclass
class AllReleases:
    """Every dated release that can be read, and what became of the others."""

    frame: DataFrame
    bronze: Bronze
    located: DataFrame
    missing: DataFrame  # items of the catalog without an archive

    def identifier(self, kind: str) -> str:
        return loaded_identifier(self.located, self.bronze, kind)


def ingest_all(catalog: DataFrame, archives: DataFrame) -> AllReleases:
    """Every dated release, merged into one frame; unreadable ones are skipped."""
    dated = cat.dated(catalog)
    located = cat.locate(dated, archives)
    cat.require_one_each(located)
    bronze = read_bronze(located, "skip")
    return AllReleases(
        merged_frame(bronze), bronze, located, cat.not_landed(dated, archives)
    )


def loaded_identifier(located: DataFrame, bronze: Bronze, kind: str) -> str:
    return metrics.range_identifier(bronze.without_bad(located), kind).first()["identifier"]


def target_rows(frame: DataFrame, *, kind: str, identifier: str, now) -> DataFrame:
    """Rows of the target table: renamed fields, metadata, insertion time."""
    named = fr.add_lineage(fr.rename_columns(frame), data_date=identifier, now=now, kind=kind)
    return fr.target_projection(named)


def deliver(frame: DataFrame, *, kind: str, identifier: str, folder: str, now,
            requested: str = "csv", write_database=None, on_saved=None, one_file: bool = False) -> dict:
    """Save one run's frame by the rules: database first, else a file named by rule.

    `write_database(rows)` gets the target rows, staged once.  Without it, or where it
    fails, the renamed records with their metadata go to a file in `folder`, as
    `requested` or as CSV where a workbook is too small (with `one_file` as one file, not
    as a folder of parts).  Returns `target`
    (database or file), `format` and `path`.
    """
    saved = {"target": "database", "format": None, "path": None}

    def write_file(_):
        named = fr.add_lineage(fr.rename_columns(frame), data_date=identifier, now=now, kind=kind)
        # The count decides the name, so it is made before anything is written.
        written = sinks.route_format(named, requested)
        extension = "xlsx" if written == "excel" else "csv"
        path = f"{folder.rstrip('/')}/{sinks.output_name(kind, identifier, now, extension)}"
        saved.update(target="file", path=path)
        saved["format"] = sinks.save_file(named, path, written, on_saved=on_saved, one_file=one_file)

    rows = target_rows(frame, kind=kind, identifier=identifier, now=now)
    sinks.save_with_fallback(rows, write_database, write_file)
    return saved


def save_release(archives: DataFrame, *, kind: str, identifier: str, write=None,
                 on_bad_archive: str = "fail", folder: str | None = None, now=None,
                 requested: str = "csv", write_database=None, on_saved=None,
                 one_file: bool = False) -> dict:
    """Ingest, save, and report on the run.

    The frame goes to `write(frame)`, or without it through `deliver` to a database
    or to `folder`.  Where there are no records there is nothing to write.
    """
    started = time.monotonic()
    bronze = read_bronze(archives, on_bad_archive)
    frame = merged_frame(bronze, sort=kind != "full")
    saved = {"target": None, "format": None, "path": None}
    if frame.columns and write is not None:
        write(frame)
    elif frame.columns:
        saved = deliver(
            frame, kind=kind, identifier=identifier, folder=folder, now=now, requested=requested,
            write_database=write_database, on_saved=on_saved, one_file=one_file,
        )
    seconds = time.monotonic() - started
    sizes = metrics.archive_bytes(entry_manifest(bronze.slices))
    total = sizes.agg(F.sum("total_bytes").alias("bytes"), F.count("*").alias("archives")).first()
    mib = (total["bytes"] or 0) / (1 << 20)
    return {
        "kind": kind,
        "identifier": identifier,
        "archives": total["archives"],
        "records": bronze.record_count(),
        "failures": bronze.failure_count(),
        "mib": mib,
        "seconds": seconds,
        "mib_per_second": mib / seconds if seconds > 0 else 0.0,
        "unmapped": fr.unmapped_columns(fr.rename_columns(frame)),
        **saved,
    }


REPORT_SCHEMA = (
    "kind string, identifier string, archives long, records long, failures long, mib double, "
    "seconds double, mib_per_second double, unmapped array<string>, target string, "
    "format string, path string"
)


def append_report(spark: SparkSession, report: dict, path: str) -> None:
    """Add the report of a run to the table of reports."""
    spark.createDataFrame([report], REPORT_SCHEMA).write.mode("append").parquet(path)
