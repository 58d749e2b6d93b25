"""Decision links of saved search pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelframe import schemas
from gavelframe.functions import codebook as cb
from gavelframe.functions import html as hx
from gavelframe.functions import text as tx
from gavelframe.functions import urls
from gavelframe.session import settle


def page_links(
    pages: DataFrame,
    base_url: Column,
    markers: Sequence[str] = cb.LINK_MARKERS,
    id_parameter: str = cb.LINK_ID_PARAMETER,
    dropped_title: str = cb.LINK_DROPPED_TITLE,
) -> DataFrame:
    """One row per decision link: page columns plus ``position, title, url, docid``.

    Anchors are cut out and tested inside the page's row; only links that stay
    are exploded, and the page markup itself is not carried along.
    """
    carried = [c for c in pages.columns if c != "html"]
    links = pages.select(
        *carried,
        base_url.alias("_base"),
        F.posexplode(hx.anchor_markup(hx.drop_noise(F.col("html")))).alias("position", "_anchor"),
    )
    links = settle(links.withColumn("_href", hx.anchor_href(F.col("_anchor"))))
    links = links.where(tx.contains_any(F.col("_href"), markers))
    links = settle(links.withColumn("title", hx.fragment_text(F.col("_anchor"))))
    links = links.where(~F.contains(F.lower("title"), F.lit(dropped_title)))
    links = links.withColumn("url", urls.join_url(F.col("_base"), F.col("_href")))
    docid = F.coalesce(urls.query_parameter(F.col("url"), id_parameter), F.col("url"))
    return settle(links.withColumn("docid", docid).drop("_base", "_anchor", "_href"))


def first_link_wins(links: DataFrame, page_key: Sequence[str]) -> DataFrame:
    """Keep the first link of a docid within each page.

    All links of a page come out of one task, so the partial aggregate removes
    the repeats before anything is shuffled.
    """
    keys = [*page_key, "docid"]
    rest = [c for c in links.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.col("position")).alias("_first")
    return links.groupBy(*keys).agg(first).select(*keys, *[f"_first.{c}" for c in rest])


def contiguous_pages(pages: DataFrame, day: str, page: str, has_links: Column, max_pages: int) -> DataFrame:
    """Pages 1..k of each day, where k is the last page before the first one that is
    missing or has no links; never beyond ``max_pages``.

    A day's page numbers are at most ``max_pages`` small integers, so the set
    that is gathered per day is bounded whatever the number of rows.
    """
    if max_pages < 1:
        raise ValueError("max_pages_per_day must be at least 1")
    linked = (
        pages.where(F.col(page).between(1, max_pages))
        .groupBy(day, page)
        .agg(F.max(has_links).alias("_linked"))
        .where("_linked")
    )
    numbers = linked.groupBy(day).agg(F.sort_array(F.collect_set(page)).alias("_pages"))
    run = F.filter("_pages", lambda p, i: p == i + 1)
    accepted = numbers.select(day, F.explode(run).alias(page))
    return pages.join(accepted, [day, page], "left_semi")


def as_decisions(links: DataFrame, decision_date: Column, search_page_path: Column) -> DataFrame:
    """Links as decision records with the constant source columns."""
    return links.select(
        "docid",
        "title",
        "url",
        decision_date.alias("decision_date"),
        search_page_path.alias("search_page_path"),
        F.lit(cb.DISCOVERY_SOURCE).alias("source"),
        F.lit(cb.DISCOVERY_LANGUAGE).alias("language"),
        F.lit(cb.DISCOVERY_COURT).alias("court"),
    ).select(*schemas.DECISION.fieldNames())


def days_between(start: Column, end: Column) -> Column:
    """Array of the days from start to end, both included; an end before the start is an error."""
    ordered = F.when(end < start, F.raise_error(F.lit("end_date must be on or after start_date"))).otherwise(end)
    return F.sequence(start, ordered.cast("date"), F.expr("interval 1 day"))


def day_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Inclusive calendar of ISO days."""
    if end < start:
        raise ValueError("end_date must be on or after start_date")
    days = days_between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("day"))
