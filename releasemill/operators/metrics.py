"""Counts and sizes over manifests and bronze records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def record_count(frame: DataFrame) -> DataFrame:
    return frame.agg(F.count("*").alias("records"))


def archive_counts(bronze: DataFrame, archives: DataFrame) -> DataFrame:
    """Records per archive; an archive that gave none counts zero."""
    counted = bronze.select("archive", F.col("error").isNull().cast("long").alias("records"))
    listed = archives.select("archive", F.lit(0).cast("long").alias("records"))
    return counted.unionByName(listed).groupBy("archive").agg(F.sum("records").alias("records"))


def failure_count(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.count_if(F.col("error").isNotNull()).alias("failures"))


def dead_letter(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("error").isNotNull()).select(
        "archive", "parent", "entry", "error", F.coalesce("fatal", F.lit(False)).alias("fatal")
    )


def failed_places(bronze: DataFrame) -> DataFrame:
    """Failures with the places of their entries, by which these can be read again."""
    return bronze.filter(F.col("error").isNotNull()).select(
        "archive", "release_ord", "parent", "entry", "entry_ord", "error",
        F.coalesce("fatal", F.lit(False)).alias("fatal"),
    )


def archive_bytes(manifest: DataFrame) -> DataFrame:
    """Uncompressed size per archive; a nested archive counts as the one entry it is."""
    return manifest.filter(F.col("parent").isNull()).groupBy("archive").agg(
        F.sum("size").alias("total_bytes"), F.count("*").alias("entries")
    )


def entry_distribution(manifest: DataFrame) -> DataFrame:
    return manifest.filter(F.col("parent").isNull()).groupBy("archive").agg(
        F.count_if(F.col("kind") == "xml").alias("xml_entries"),
        F.count_if(F.col("kind").isin("zip", "excel")).alias("other_entries"),
    )


def catalog_count(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.count("*").alias("releases"))


def range_identifier(releases: DataFrame, kind: str) -> DataFrame:
    """Label of a merged output from the `date_str` of the releases that loaded.

    Weekly releases give `min~max`, other kinds the minimum, none at all `all`.
    """
    low, high = F.min("date_str"), F.max("date_str")
    label = F.concat(low, F.lit("~"), high) if kind == "weekly" else low
    return releases.agg(F.coalesce(label, F.lit("all")).alias("identifier"))
