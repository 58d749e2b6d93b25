"""State of the registry log and the download plan that follows from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelframe import schemas
from gavelframe.functions import codebook as cb
from gavelframe.functions import text as tx
from gavelframe.session import spread_key
from gavelframe.sources import pages, paths

LOG_ORDER = ("batch_seq", "file_name", "line_no", "scraped_at")


def record_key(docid: Column, url: Column) -> Column:
    """Non-empty docid, else non-empty URL, else NULL."""
    return F.coalesce(tx.null_if_empty(docid), tx.null_if_empty(url))


def log_order(log: DataFrame, order: Sequence[str] = LOG_ORDER) -> Column:
    """Sortable position of a record; times are compared as times, not as text."""
    parts = []
    for name in (c for c in order if c in log.columns):
        text = name != "file_name" and log.schema[name].dataType.simpleString() == "string"
        parts.append((F.col(name).try_cast("timestamp") if text else F.col(name)).alias(name))
    if not parts:
        raise ValueError(f"the log has none of the order columns {list(order)}")
    return F.struct(*parts)


def latest_by(log: DataFrame, key: Column, order: Sequence[str] = LOG_ORDER) -> DataFrame:
    """Latest record of each non-NULL key, with the key as ``record_key``.

    The aggregate keeps one record per key and task before the shuffle, so a
    key with a third of the log costs no more than any other.
    """
    record = F.struct(*[F.col(c) for c in log.columns])
    keyed = log.select(key.alias("record_key"), record.alias("_record"), log_order(log, order).alias("_order"))
    latest = keyed.where(F.col("record_key").isNotNull()).groupBy("record_key").agg(
        F.max_by("_record", "_order").alias("_record")
    )
    return latest.select("record_key", "_record.*")


def registry_index(log: DataFrame, order: Sequence[str] = LOG_ORDER) -> DataFrame:
    return latest_by(log, record_key(F.col("docid"), F.col("url")), order)


def registry_by_path(log: DataFrame, order: Sequence[str] = LOG_ORDER, root: str | None = None) -> DataFrame:
    """Latest record per page. Records without a path do not hide earlier ones."""
    return latest_by(log, paths.path_key(tx.null_if_empty(F.col("raw_html_path")), root), order).drop("record_key")


def is_downloaded(status: Column, raw_html_path: Column) -> Column:
    flag = status.isin(*cb.DOWNLOADED_STATUSES) & (raw_html_path != "")
    return F.coalesce(flag, F.lit(False))


def is_error(status: Column) -> Column:
    return F.coalesce(status == cb.ERROR_STATUS, F.lit(False))


def existing_downloads(index: DataFrame, listing: DataFrame, root: str | None = None) -> DataFrame:
    """Downloaded records whose file is in the listing, in whatever form either writes its path."""
    done = index.where(is_downloaded(F.col("status"), F.col("raw_html_path")))
    done = done.withColumn("_path", paths.path_key(F.col("raw_html_path"), root))
    files = listing.select(paths.path_key(F.col("raw_html_path"), root).alias("_path"))
    return done.join(files, "_path", "left_semi").select(*index.columns)


def _first_per_docid(decisions: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    # Decisions without a docid are told apart by their URL.
    key = record_key(F.col("docid"), F.col("url"))
    first = F.min_by(F.struct(*decisions.columns), F.struct(*order)).alias("_first")
    return decisions.groupBy(key.alias("_key")).agg(first).select("_first.*")


def download_plan(
    decisions: DataFrame,
    index: DataFrame,
    listing: DataFrame,
    force: bool = False,
    retry_errors: bool = False,
    order: Sequence[str | Column] | None = None,
    root: str | None = None,
) -> DataFrame:
    """Decisions to fetch.

    Forced runs take all. Otherwise a decision is looked up by docid, then by
    URL; it is left out when its page exists, or when its latest record is an
    error and errors are not retried. A docid met twice is fetched once.
    """
    if force:
        return decisions
    if order is None:
        page = pages.page_name_fields(F.col("search_page_path"))[1]  # as a number: page 2 comes before page 10
        order = ("decision_date", page.alias("page"), "search_page_path", "url")
    wanted = _first_per_docid(decisions, order)
    on_file = listing.select(paths.path_key(F.col("raw_html_path"), root).alias("_file")).distinct()
    downloaded = is_downloaded(F.col("status"), F.col("raw_html_path"))
    state = index.select(
        "record_key",
        downloaded.alias("_downloaded"),
        is_error(F.col("status")).alias("_error"),
        spread_key(paths.path_key(F.col("raw_html_path"), root), downloaded, F.col("record_key")).alias("_path"),
    )
    state = state.join(on_file, F.col("_path") == F.col("_file"), "left").select(
        "record_key", "_error", F.col("_file").isNotNull().alias("_exists")
    )
    state = state.select("record_key", F.struct("_exists", "_error").alias("_state"))

    by_docid = state.select(F.col("record_key").alias("_docid_key"), F.col("_state").alias("_by_docid"))
    by_url = state.select(F.col("record_key").alias("_url_key"), F.col("_state").alias("_by_url"))
    # One row per docid on both sides: no key is heavy, and the aggregates'
    # partitioning serves the join.
    looked_up = wanted.join(by_docid, F.col("docid") == F.col("_docid_key"), "left")
    # Only decisions still unknown need the second lookup.
    unknown = F.col("_by_docid").isNull() & (F.col("url") != "")
    looked_up = looked_up.withColumn("_url", spread_key(F.col("url"), unknown, F.col("docid")))
    looked_up = looked_up.join(by_url, F.col("_url") == F.col("_url_key"), "left")
    latest = F.coalesce("_by_docid", "_by_url")
    skip = F.coalesce(latest["_exists"], F.lit(False))
    if not retry_errors:
        skip = skip | F.coalesce(latest["_error"], F.lit(False))
    return looked_up.where(~skip).select(*decisions.columns)


def _log_columns(rows: DataFrame) -> DataFrame:
    fields = [f for f in schemas.REGISTRY.fields if f.name != "batch_seq"]  # stamped when appended
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def _of_decisions(decisions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Decisions with their outcomes: by docid, or by URL where there is no docid. A decision that was planned twice counts once."""
    one_each = _first_per_docid(decisions, ("decision_date", "search_page_path", "url"))
    named = one_each.withColumn("_key", record_key(F.col("docid"), F.col("url")))
    url = F.col("url") if "url" in outcomes.columns else F.lit(None).cast("string")
    keyed = outcomes.withColumn("_key", record_key(F.col("docid"), url)).drop("docid", "url")
    return named.join(keyed, "_key").drop("_key")


def success_rows(decisions: DataFrame, results: DataFrame) -> DataFrame:
    """Log rows of fetched decisions. ``results``: docid (and url, for decisions
    without a docid), status, http_status, raw_html_path, content_hash, scraped_at."""
    rows = _of_decisions(decisions, results).withColumn("error_message", F.lit(None).cast("string"))
    return _log_columns(rows.withColumn("decision_date", F.date_format("decision_date", "yyyy-MM-dd")))


def error_rows(decisions: DataFrame, failures: DataFrame) -> DataFrame:
    """Log rows of failed decisions. ``failures``: docid (and url), message, scraped_at."""
    # Cut before the join: only what the log keeps of a message is shuffled and sorted.
    short = failures.withColumn("message", tx.prefix(F.col("message"), cb.ERROR_MESSAGE_CHARS))
    rows = _of_decisions(decisions, short)
    nothing = {c: F.lit(None).cast("string") for c in ("http_status", "raw_html_path", "content_hash")}
    return _log_columns(
        rows.withColumns(
            {
                "status": F.lit(cb.ERROR_STATUS),
                "error_message": F.col("message"),
                "decision_date": F.date_format("decision_date", "yyyy-MM-dd"),
                **nothing,
            }
        )
    )
