"""Ingesting all releases over several runs, each of which takes only what is left.

Releases are taken in batches.  A batch claims its releases, parses them, and publishes
records, states, failures and field layouts in one step (`operators.published`), so a
release counts exactly when its records do.  A run that was stopped is repeated: it
takes the releases that failed, changed, or were not reached.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from releasemill.model import KNOWN_FIELDS, LINEAGE, wide_bronze_schema
from releasemill.operators import catalog as cat
from releasemill.operators import frame as fr
from releasemill.operators import metrics
from releasemill.operators.published import PublishedTable, SmallFiles
from releasemill.plans.ingest import read_bronze, read_entries
from releasemill.workspace import materialise, small_side

# A batch holds at least the first number of releases, and above it as many as the other bounds
# allow: every batch has a fixed cost of its own, so small archives are taken many at a time.
BATCH_RELEASES = 64
MOST_BATCH_RELEASES = 4096
BATCH_BYTES = 16 << 30
LEASE_SECONDS = 6 * 3600
# Of claims that meet, one waits this long, so often, for the other to be withdrawn.
SETTLE_SECONDS, SETTLE_CHECKS = 0.1, 10

RELEASES = "run string, number long, archive string, length long, modification_time timestamp, ok boolean"
FAILURES = (
    "run string, archive string, release_ord long, parent string, entry string, entry_ord long, "
    "error string, fatal boolean"
)
REPLAYS = "run string, archive string, release_ord long, entry_ord long, replay string, ok boolean"
LAYOUTS = "run string, layout string, " + ", ".join(
    f"{name} {'string' if name == 'archive' else 'long'}" for name in LINEAGE
)

# Where an entry sits.
PLACE = ["archive", "release_ord", "entry_ord"]


@dataclass
class Taken:
    """What a run did: releases read, releases that could not be, and those another run holds."""

    read: int = 0
    failed: int = 0
    held: int = 0


@dataclass
class Replayed:
    """What a replay did: entries read now, entries that fail still, and releases another run holds."""

    read: int = 0
    failed: int = 0
    held: int = 0


class Ledger:
    """Releases taken so far, with their records."""

    def __init__(self, spark: SparkSession, path: str, columns=KNOWN_FIELDS):
        self.spark, self.table, self.columns = spark, PublishedTable(spark, path), tuple(columns)

    # --- state

    def releases(self) -> DataFrame:
        """Every release as each run found it."""
        return self.table.read("releases", RELEASES)

    def current(self) -> DataFrame:
        """`archive, run, length, modification_time` of the last run that read each archive."""
        last = F.max_by(F.struct("run", "length", "modification_time"), F.struct("number", "run"))
        return self.releases().where("ok").groupBy("archive").agg(last.alias("last")).select("archive", "last.*")

    def waiting(self, located: DataFrame) -> DataFrame:
        """Releases that were never read as they are now: new, failed or changed ones."""
        done = materialise(self.current().select("archive", "length", "modification_time"), "done")
        return located.join(small_side(done, done.count()), ["archive", "length", "modification_time"], "left_anti")

    # --- claims

    @functools.cached_property
    def _claims(self) -> SmallFiles:
        return SmallFiles(self.spark, f"{self.table.path}/claims")

    @staticmethod
    def _claim_name(release) -> str:
        name = f"{release['archive']}|{release['length']}|{release['modification_time']}"
        return hashlib.sha256(name.encode()).hexdigest()

    def _held(self) -> dict[str, dict]:
        """Claims by their files: `owner`, `until`, `rank` and the names of the `releases`."""
        held = {}
        for file in self._claims.names():
            claim = json.loads(self._claims.read(file) or "{}")
            if claim:  # else let go meanwhile
                # Those of earlier versions stand for the one release they are named by.
                held[file] = {"rank": file, "releases": [file], **claim}
        return held

    def _claim_all(self, names, owner: str, lease: float) -> set[str]:
        """Claim releases, by their names, in one file; returns those that `owner` has now.

        A claim is announced before others are looked for, and stands when a look finds none that it
        meets: of two that are made at once, one at least sees the other.  The one of higher rank is
        withdrawn then.  The other waits for that, and is withdrawn too where the first stands.
        """
        rank, left, checks = uuid.uuid4().hex, set(names), SETTLE_CHECKS
        while left:
            file = uuid.uuid4().hex
            claim = {"owner": owner, "until": time.time() + lease, "rank": rank, "releases": sorted(left)}
            self._claims.create(file, json.dumps(claim))
            while True:
                met = [
                    (other["rank"], left.intersection(other["releases"])) for other in self._held().values()
                    if other["owner"] != owner and other["until"] > time.time()
                ]
                met = [(other, both) for other, both in met if both]
                if not met:
                    return left
                if not checks or any(other < rank for other, _ in met):
                    break
                checks -= 1
                time.sleep(SETTLE_SECONDS)
            self._claims.delete(file)
            left.difference_update(*(both for other, both in met if not checks or other < rank))
        return left

    def claim(self, release, owner: str, lease: float) -> bool:
        """Take a release for `owner`; one that another owner holds stays with it until its lease ends."""
        return bool(self._claim_all([self._claim_name(release)], owner, lease))

    def _release_claims(self, releases, owner: str | None = None) -> None:
        """Let go of releases that `owner`, or anyone, holds, and of claims whose lease has ended."""
        gone = set(map(self._claim_name, releases))
        for file, claim in self._held().items():
            rest = set(claim["releases"]) - gone
            if owner in (None, claim["owner"]) and len(rest) < len(claim["releases"]):
                if rest:  # a stopped run of this owner had other batches
                    self._claims.create(uuid.uuid4().hex, json.dumps({**claim, "releases": sorted(rest)}))
                self._claims.delete(file)
            elif claim["until"] <= time.time():
                self._claims.delete(file)

    def _claimed(self, rows: DataFrame, owner: str, lease: float) -> tuple[DataFrame, list, int]:
        """Of a batch's releases those that `owner` could claim, as rows and as a list, and the number of others."""
        wanted = rows.select("archive", "length", "modification_time").collect()
        got = self._claim_all(map(self._claim_name, wanted), owner, lease)
        own = [release for release in wanted if self._claim_name(release) in got]
        if len(own) < len(wanted):
            keys = self.spark.createDataFrame([(release["archive"],) for release in own], "archive string")
            rows = rows.join(F.broadcast(keys), "archive", "left_semi")
        return rows, own, len(wanted) - len(own)

    @staticmethod
    def _batches(left: DataFrame, batch: int | None) -> list:
        """Conditions on `place` that cut the releases of `left` into batches."""
        total = left.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
        if batch is None:
            batch = usual_batch(total["n"], total["bytes"] or 0)
        return [F.expr(f"(place - 1) div {batch}") == number for number in range(math.ceil(total["n"] / batch))]

    # --- runs

    def take(self, located: DataFrame, owner: str, batch: int | None = None, lease: float = LEASE_SECONDS) -> Taken:
        """Read the waiting releases of `located`, some `batch` at a time (without it `usual_batch`)."""
        # Numbered once, so the batches are even and stay as they are.
        placed = fr.with_position(self.waiting(located), [F.col("archive").asc()], "place")
        left = materialise(placed, "waiting")
        taken = Taken()
        for part in self._batches(left, batch):
            claimed, own, held = self._claimed(left.where(part), owner, lease)
            taken.held += held
            # Another run may have read and let go of one between listing and claiming.
            rows = self.waiting(claimed)
            if not rows.isEmpty():
                read, failed = self._publish(rows)
                taken.read, taken.failed = taken.read + read, taken.failed + failed
            self._release_claims(own, owner)
        return taken

    def open_failures(self) -> DataFrame:
        """Failed entries of the releases as they were last read that no replay has read since.

        Failures that void a whole release are not among them: `take` reads those again.
        """
        noted = self.failures().where(~F.col("fatal") & F.col("entry_ord").isNotNull())
        mended = self.table.read("replays", REPLAYS).where("ok").select("run", *PLACE).distinct()
        return self._of_current(noted, keep_run=True).join(mended, ["run", *PLACE], "left_anti")

    def replay(self, located: DataFrame, owner: str, batch: int | None = None, lease: float = LEASE_SECONDS) -> Replayed:
        """Read the failed entries again, and nothing else, of releases that are as they were last read.

        Their records join those of the run that read the release, at the places of their entries, so the
        frame is the one a run without failures had given.  An entry that fails again stays open.
        """
        same = located.join(self.current().select("archive", "length", "modification_time"),
                            ["archive", "length", "modification_time"], "left_semi")
        held = same.join(self.open_failures().select("archive").distinct(), "archive", "left_semi")
        left = materialise(fr.with_position(held, [F.col("archive").asc()], "place"), "replayed")
        done = Replayed()
        for part in self._batches(left, batch):
            rows, own, held = self._claimed(left.where(part), owner, lease)
            done.held += held
            # Listed again under the claims: another run may have replayed some, or read a release anew.
            last = F.broadcast(rows.select("archive"))
            open_now = materialise(self.open_failures().join(last, "archive", "left_semi"), "open")
            if not open_now.isEmpty():
                read, failed = self._publish_replay(rows, open_now)
                done.read, done.failed = done.read + read, done.failed + failed
            self._release_claims(own, owner)
        return done

    def _publish_replay(self, rows: DataFrame, open_now: DataFrame) -> tuple[int, int]:
        replay = uuid.uuid4().hex
        places = open_now.select(*PLACE, "run").distinct()
        bronze = read_entries(rows, places.select(*PLACE), self.columns)
        # Read is what was found in its archive and gave no failure there.
        met = bronze.slices.frame.select(
            "archive", "release_ord", F.explode(F.coalesce("only", F.array("slice_no"))).alias("entry_ord")
        )
        failed = bronze.rows.where("error is not null").select(*PLACE)
        read = bronze.without_bad(met.join(failed, PLACE, "left_anti")).distinct().withColumn("read", F.lit(True))
        state = places.join(read, PLACE, "left").select(
            "run", *PLACE, F.lit(replay).alias("replay"), F.col("read").isNotNull().alias("ok")
        )
        state = materialise(state, "replay")
        # Records count with the run that read the rest of their release.
        runs = open_now.select("archive", "run").distinct()
        records = bronze.records.join(F.broadcast(runs), "archive")
        records = records.select("run", *[c for c in records.columns if c != "run"])
        self.table.append(replay, {"records": records, "layouts": self._layouts(records), "replays": state})
        bronze.release()
        found = {row["ok"]: row["count"] for row in state.groupBy("ok").count().collect()}
        return found.get(True, 0), found.get(False, 0)

    @staticmethod
    def _layouts(records: DataFrame) -> DataFrame:
        first = F.min(F.struct(*LINEAGE)).alias("first")
        return records.groupBy("run", "layout").agg(first).select("run", "layout", "first.*")

    def _publish(self, rows: DataFrame) -> tuple[int, int]:
        run = uuid.uuid4().hex
        # Later runs have higher numbers, also where clocks differ: each counts those before it.
        number = self.table.parts().select("run").distinct().count()
        bronze = read_bronze(rows, "skip", self.columns)
        named = F.lit(run).alias("run")
        records = bronze.records.select(named, "*")
        state = rows.select(named, F.lit(number).cast("long").alias("number"), "archive", "length", "modification_time")
        if bronze.bad_archives is None:
            state = state.withColumn("ok", F.lit(True))
        else:
            bad = bronze.bad_archives.select(F.col("archive").alias("bad"))
            state = state.join(bad, F.col("archive") == F.col("bad"), "left").withColumn("ok", F.col("bad").isNull()).drop("bad")
        state = materialise(state, "state")
        self.table.append(run, {
            "records": records, "releases": state, "layouts": self._layouts(records),
            "failures": metrics.failed_places(bronze.rows).select(named, "*"),
        })
        bronze.release()
        counts = state.groupBy("ok").count().collect()
        found = {row["ok"]: row["count"] for row in counts}
        return found.get(True, 0), found.get(False, 0)

    # --- results

    def _of_current(self, frame: DataFrame, keep_run: bool = False) -> DataFrame:
        last = materialise(self.current().select(F.col("archive").alias("of"), F.col("run").alias("of_run")), "current")
        match = (frame["archive"] == F.col("of")) & (frame["run"] == F.col("of_run"))
        found = frame.join(small_side(last, last.count()), match, "left_semi")
        return found if keep_run else found.drop("run")

    def records(self) -> DataFrame:
        """Records of each archive as it was last read."""
        schema = wide_bronze_schema(self.columns)
        names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in ("error", "fatal"))
        return self._of_current(self.table.read("records", f"run string, {names}"))

    def fields(self) -> list[str]:
        """Field names in order of first appearance, from the layouts that the runs noted."""
        return fr.field_order(self._of_current(self.table.read("layouts", LAYOUTS)))

    def failures(self) -> DataFrame:
        return self.table.read("failures", FAILURES)

    def frame(self, size_bytes: int = 0) -> DataFrame:
        """All records as one frame, columns found by any run included, ordered by record key.

        The columns come from the noted layouts, so the records are read once.
        """
        names = self.fields()
        wide = fr.widen(self.records(), names[: fr.MAX_FIELDS])
        return fr.drop_lineage(fr.sort_records(wide, size_bytes))


def usual_batch(releases: int, size_bytes: int) -> int:
    """Releases of a batch, of `releases` in all."""
    fits = releases * BATCH_BYTES // max(size_bytes, 1)
    return max(BATCH_RELEASES, min(MOST_BATCH_RELEASES, fits))


def _located(catalog: DataFrame, archives: DataFrame) -> DataFrame:
    """Landed archives of the dated releases, written once.

    Every read of a listing asks the storage for each file, and a run reads it several times.
    """
    located = materialise(cat.locate(cat.dated(catalog), archives), "located")
    cat.require_one_each(located)
    return located


def ingest_remaining(catalog: DataFrame, archives: DataFrame, path: str, owner: str = "ingest",
                     batch: int | None = None) -> Taken:
    """One run over all dated releases of a catalog: reads what no earlier run under `path` has read.

    Runs of one `owner` follow each other; those of different owners may overlap.
    """
    return Ledger(catalog.sparkSession, path).take(_located(catalog, archives), owner, batch)


def replay_failures(catalog: DataFrame, archives: DataFrame, path: str, owner: str = "ingest",
                    batch: int | None = None) -> Replayed:
    """Read the entries that earlier runs under `path` could not parse, for instance after a parser was mended."""
    return Ledger(catalog.sparkSession, path).replay(_located(catalog, archives), owner, batch)
