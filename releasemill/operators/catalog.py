"""Release catalog: build, order, choose, list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from releasemill.functions import titles
from releasemill.model import KINDS

# Newest first, undated last, ties in feed order.
def catalog_order() -> list[Column]:
    return [F.col("date").desc_nulls_last(), F.col("feed_pos").asc()]


def build_catalog(items: DataFrame) -> DataFrame:
    """Dated catalog from `kind, feed_pos, title, link`.

    A title that does not match stays, without date; only an unknown kind drops
    its items.
    """
    kind, title = F.col("kind"), F.col("title")
    texts = items.filter(kind.isin(*KINDS)).select(
        kind,
        F.col("feed_pos").cast("long").alias("feed_pos"),
        title,
        "link",
        titles.title_date_text(kind, title).alias("date_str"),
        titles.title_period(kind, title).alias("period_str"),
    )
    # A second step, so the title is searched once however often its date is used.
    return texts.select(
        "kind", "feed_pos", "title", "link", "date_str",
        titles.release_date(kind, F.col("date_str")).alias("date"),
        "period_str",
    )


def dated(catalog: DataFrame) -> DataFrame:
    """Items with a date text, valid as a date or not."""
    return catalog.filter(F.col("date_str").isNotNull() & (F.col("date_str") != ""))


def latest(catalog: DataFrame) -> DataFrame:
    return catalog.orderBy(*catalog_order()).limit(1)


def find_by_date(catalog: DataFrame, date_text: str) -> DataFrame:
    """First item, in catalog order, with this date text."""
    return latest(catalog.filter(F.col("date_str") == date_text))


def by_ordinal(catalog: DataFrame, ordinal: int) -> DataFrame:
    """The n-th item, 1-based; no row when out of range."""
    if ordinal < 1:
        return catalog.limit(0)
    return catalog.orderBy(*catalog_order()).offset(ordinal - 1).limit(1)


def listing(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        "kind",
        "feed_pos",
        titles.listing_label(F.col("kind"), F.col("date"), F.col("period_str")).alias("label"),
        "title",
    )


def with_identifier(catalog: DataFrame) -> DataFrame:
    return catalog.withColumn(
        "identifier", titles.release_identifier(F.col("period_str"), F.col("date_str"))
    )


def order_number() -> Column:
    """One number that sorts like `catalog_order`, without sorting anything."""
    day = F.coalesce(F.unix_date(F.lit("9999-12-31").cast("date")) - F.unix_date("date"),
                     F.lit(2**30))
    return F.shiftleft(day.cast("long"), 32) + F.col("feed_pos")


def link_file_name() -> Column:
    """Last part of a link's path, without query and fragment, percent signs decoded."""
    path = F.regexp_extract("link", "^[^?#]*", 0)
    name = F.element_at(F.split(path, "/"), -1)
    # The decoder is one for forms, where a plus sign is a blank.
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def _wanted(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        link_file_name().alias("file_name"),
        order_number().alias("release_ord"),
        "kind",
        "date_str",
        "period_str",
    )


def _keys(archives: DataFrame) -> list[str]:
    """What tells archives apart: the name, and the kind where folders give it."""
    return ["file_name", "kind"] if "kind" in archives.columns else ["file_name"]


def locate(catalog: DataFrame, archives: DataFrame) -> DataFrame:
    """Landed archives of the catalog's items, in catalog order.

    Archives that know their kind are matched on it as well.  An item that has
    not landed gives no row, see `not_landed`.
    """
    clash = [c for c in ("date_str", "period_str") if c in archives.columns]
    return archives.drop("release_ord", *clash).join(_wanted(catalog), _keys(archives))


def not_landed(catalog: DataFrame, archives: DataFrame) -> DataFrame:
    """The catalog's items without an archive: `file_name, kind, date_str, period_str`."""
    missing = _wanted(catalog).join(archives, _keys(archives), "left_anti")
    return missing.select("file_name", "kind", "date_str", "period_str")


class AmbiguousRelease(Exception):
    """Several landed archives could be the release asked for."""


def require_one_each(located: DataFrame) -> None:
    """Fail where one item of the catalog matches several archives."""
    several = (
        located.groupBy("release_ord", "kind", "file_name").count().filter("count > 1")
        .select("kind", "file_name").limit(5).collect()
    )
    if several:
        shown = [tuple(row) for row in several]
        raise AmbiguousRelease(f"more than one landed archive for {shown}")
