"""A registry of record layouts that batches add to.

Each batch notes the layouts it is the first to bring, a row each, in a folder of its own.
The fields that all batches know together, in order of first appearance, follow from these
rows alone, whatever the records' number; a batch that is repeated replaces what it noted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from releasemill.model import LAYOUT_SEP, LINEAGE
from releasemill.operators.frame import CASE_SENSITIVE, MAX_FIELDS
from releasemill.workspace import exists, qualified

SCHEMA = "layout string, " + ", ".join(
    f"{name} {'string' if name == 'archive' else 'long'}" for name in LINEAGE
)


class LayoutRegistry:
    """Layouts under `path`, a folder on shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, qualified(spark, path).rstrip("/")

    def layouts(self) -> DataFrame:
        """`layout`, the place of its first record, and the batch that brought it."""
        schema = f"{SCHEMA}, batch long"
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def note(self, batch: int, records: DataFrame) -> None:
        """Add the layouts of `records` that no earlier batch has."""
        earlier = self.layouts().where(F.col("batch") < batch).select("layout").distinct()
        first = F.min(F.struct(*LINEAGE)).alias("first")
        own = records.groupBy("layout").agg(first).select("layout", "first.*")
        own.join(earlier, "layout", "left_anti").write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def fields(self, upto: int | None = None, reserved=()) -> list[str]:
        """At most MAX_FIELDS field names that batches up to `upto` know, in order of first appearance.

        Names that are `reserved`, or differ from an earlier one in case only where the session
        ignores case, cannot be columns and are left out.
        """
        known = self.layouts() if upto is None else self.layouts().where(F.col("batch") <= upto)
        names = (
            known.select(F.struct("batch", *LINEAGE).alias("first"), F.posexplode(F.split("layout", LAYOUT_SEP)).alias("pos", "name"))
            .where("name <> ''").groupBy("name").agg(F.min(F.struct("first", "pos")).alias("seen"))
        )
        fold = str if self.spark.conf.get(CASE_SENSITIVE) == "true" else str.lower
        taken, found = {fold(name) for name in reserved}, []
        for row in names.orderBy("seen").limit(MAX_FIELDS).collect():
            if fold(row["name"]) not in taken:
                taken.add(fold(row["name"]))
                found.append(row["name"])
        return found
