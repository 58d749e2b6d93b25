"""From saved search pages and the registry log to a download plan and log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelframe.functions import codebook as cb
from gavelframe.operators import incremental as inc
from gavelframe.operators import links as lk
from gavelframe.operators import registry as rg
from gavelframe.session import cut, watched
from gavelframe.sources import pages as pg
from gavelframe.sources import paths, records


def discovered(
    search_pages: DataFrame, base_url: str, start: str, end: str, max_pages_per_day: int = 100
) -> DataFrame:
    """Decisions linked from the saved search pages (``raw_html_path, html``) of a date span.

    A day counts up to its first page without links. The date filter works on
    file names, before any page is taken apart.
    """
    if end < start:
        raise ValueError("end_date must be on or after start_date")
    if max_pages_per_day < 1:
        raise ValueError("max_pages_per_day must be at least 1")
    day, page = pg.page_name_fields(F.col("raw_html_path"))
    named = search_pages.withColumns({"day": day, "page": page})
    named = named.where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    links = lk.page_links(named, F.lit(base_url))
    unique = lk.first_link_wins(links, ["raw_html_path", "day", "page"])
    kept = lk.contiguous_pages(unique, "day", "page", F.lit(True), max_pages_per_day)
    return lk.as_decisions(kept, F.col("day"), F.col("raw_html_path"))


def plan_run(
    spark: SparkSession,
    search_folder: str,
    judgment_folder: str,
    registry_path: str,
    base_url: str,
    start: str,
    end: str,
    max_pages_per_day: int = 1000,
    limit: int = 0,
    force: bool = False,
    retry_errors: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Decisions to fetch, with their target path, and the counters of the plan."""
    decisions = discovered(pg.read_pages(spark, search_folder), base_url, start, end, max_pages_per_day)
    # Links are used twice, and their extraction is the costly part.
    decisions, found = watched(decisions, n=F.count(F.lit(1)))
    decisions = cut(decisions, "decisions")
    index = rg.registry_index(records.read_registry(spark, registry_path))
    listing = pg.list_page_files(spark, judgment_folder)
    wanted = rg.download_plan(decisions, index, listing, force, retry_errors, root=judgment_folder)
    target = paths.digest_path(judgment_folder, F.col("docid"), F.col("url"))
    page = pg.page_name_fields(F.col("search_page_path"))[1]
    ordered = inc.limit_pending(wanted, limit, "decision_date", page, "search_page_path", "url")
    ordered, chosen = watched(ordered.withColumn("target_path", target), n=F.count(F.lit(1)))
    planned = cut(ordered, "download-plan")
    counted = {"discovered": found("n"), "planned": chosen("n")}
    counters = spark.createDataFrame([counted], "discovered long, planned long")
    return planned, counters


def run_counts(counters: DataFrame, rows: DataFrame) -> dict[str, int]:
    """attempted, downloaded, skipped and errors of a run, from its plan's counters and the log rows of its outcomes."""
    plan = counters.head()
    done = rows.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("status").isin(*cb.DOWNLOADED_STATUSES)).alias("downloaded"),
        F.count_if(rg.is_error(F.col("status"))).alias("errors"),
    ).head()
    return {**done.asDict(), "skipped": plan["discovered"] - plan["planned"]}


def log_rows(decisions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Registry rows for fetch outcomes: ``docid (and url), status, ..., message``. Any other status is logged as an error."""
    fetched = F.coalesce(F.col("status").isin(*cb.DOWNLOADED_STATUSES), F.lit(False))
    good = outcomes.where(fetched).drop("message")
    odd = F.concat(F.lit("unexpected status: "), F.coalesce("status", F.lit("none")))
    message = F.coalesce("message", F.when(~rg.is_error(F.col("status")), odd))
    names = [c for c in ("docid", "url") if c in outcomes.columns]
    bad = outcomes.where(~fetched).select(*names, message.alias("message"), "scraped_at")
    return rg.success_rows(decisions, good).unionByName(rg.error_rows(decisions, bad))
