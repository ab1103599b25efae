"""Release titles, dates, identifiers and output names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from releasemill.model import TITLE_PATTERNS

UNKNOWN = "unknown"


def _found(text: Column) -> Column:
    """A regular expression that does not match extracts an empty text."""
    return F.nullif(text, F.lit(""))


def title_date_text(kind: Column, title: Column) -> Column:
    """The date part of a title: a weekly release counts by its end date."""
    chain = F.lit(None).cast("string")
    for name, pattern in TITLE_PATTERNS.items():
        part = F.regexp_extract(title, pattern, 2 if name == "weekly" else 1)
        chain = F.when(kind == name, part).otherwise(chain)
    return _found(chain)


def title_period(kind: Column, title: Column) -> Column:
    """`start~end` of a weekly title, else NULL."""
    both = TITLE_PATTERNS["weekly"].replace(")_(", "_")
    period = F.translate(F.regexp_extract(title, both, 1), "_", "~")
    return _found(F.when(kind == "weekly", period))


def release_date(kind: Column, date_text: Column) -> Column:
    """Date of a release, a month's first day; NULL when the digits are no calendar date."""
    day = F.when(kind == "monthly", F.concat(date_text, F.lit("01"))).otherwise(date_text)
    # Spark knows a year 0000, the registry's calendar does not.
    return F.when(date_text >= "0001", F.try_to_date(day, "yyyyMMdd"))


def listing_label(kind: Column, date: Column, period: Column) -> Column:
    return (
        F.when(date.isNull(), UNKNOWN)
        .when(kind == "weekly", period)
        .when(kind == "monthly", F.date_format(date, "yyyy-MM"))
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
    )


def release_identifier(period: Column, date_text: Column) -> Column:
    """The first of period and date text that is not empty."""
    return F.coalesce(
        F.nullif(period, F.lit("")), F.nullif(date_text, F.lit("")), F.lit(UNKNOWN)
    )


def output_name(kind: Column, identifier: Column, now: Column, extension: Column) -> Column:
    stamp = F.date_format(now, "yyyyMMdd_HHmmss")
    return F.concat(
        F.concat_ws("_", F.lit("udid"), kind, identifier, stamp), F.lit("."), extension
    )
