"""Registry state, download planning and incremental work on the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavelframe import schemas
from gavelframe.functions import dates
from gavelframe.operators import incremental as inc
from gavelframe.operators import links as lk
from gavelframe.operators import registry as rg
from gavelframe.sources import pages as pg
from workloads.coding_queries import widen

QUERIES = {}
ORACLES = {}

SITE = "https://example.test/u/"


def log(spark, sf_dir):
    """Events as registry records: the user is the decision, the event type its status."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", "error").when(kind == "signup", "already_exists").when(kind == "click", "skipped").otherwise("downloaded")
    )
    path = F.when(kind.isin("purchase", "signup"), F.concat(F.lit("raw/"), user, F.lit(".html"))).when(kind == "click", "")
    # Some decisions are only known by their URL, some records have neither.
    docid = F.when(F.col("user_id") < 40, F.lit("")).otherwise(F.concat(F.lit("aza://u"), user))
    url = F.when((F.col("user_id") < 40) & (F.col("value") < 1), F.lit("")).otherwise(F.concat(F.lit(SITE), user))
    return events.select(
        docid.alias("docid"),
        url.alias("url"),
        status.alias("status"),
        path.alias("raw_html_path"),
        F.col("ts").cast("string").alias("scraped_at"),
        F.col("event_id").alias("line_no"),
    )


_LOG = f"""
  SELECT CASE WHEN user_id < 40 THEN '' ELSE 'aza://u' || CAST(user_id AS VARCHAR) END AS docid,
    CASE WHEN user_id < 40 AND value < 1 THEN '' ELSE '{SITE}' || CAST(user_id AS VARCHAR) END AS url,
    CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'already_exists' WHEN 'click' THEN 'skipped' ELSE 'downloaded' END AS status,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'raw/' || CAST(user_id AS VARCHAR) || '.html' WHEN event_type = 'click' THEN '' END AS raw_html_path,
    ts, event_id AS line_no FROM events"""
_KEY = "coalesce(nullif(docid, ''), nullif(url, ''))"
_INDEX = f"""
  SELECT record_key, docid, url, status, raw_html_path, line_no FROM (
    SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY ts DESC, line_no DESC) AS rn
    FROM (SELECT *, {_KEY} AS record_key FROM ({_LOG}) AS l) AS k WHERE record_key IS NOT NULL) AS r
  WHERE rn = 1"""


def listing(spark, sf_dir):
    """Files that exist: one for each customer with an order above the highest price class."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_totalprice > 300000")
    return orders.select(F.concat(F.lit("raw/"), F.col("o_custkey").cast("string"), F.lit(".html")).alias("raw_html_path")).distinct()


_LISTING = "SELECT DISTINCT 'raw/' || CAST(o_custkey AS VARCHAR) || '.html' AS raw_html_path FROM orders WHERE o_totalprice > 300000"


def decisions(spark, sf_dir):
    """Decisions to look up: one per order date and customer, so docids repeat."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    user = F.col("o_custkey").cast("string")
    docid = F.when(F.col("o_custkey") < 40, F.concat(F.lit("aza://new"), user)).otherwise(F.concat(F.lit("aza://u"), user))
    return orders.select(
        docid.alias("docid"),
        F.concat(F.lit("title "), user).alias("title"),
        F.concat(F.lit(SITE), user).alias("url"),
        F.to_date("o_orderdate").alias("decision_date"),
        F.concat(F.lit("search/"), F.col("o_orderkey").cast("string")).alias("search_page_path"),
        F.lit("bger").alias("source"),
        F.lit("de").alias("language"),
        F.lit("BGer").alias("court"),
    )


_DECISIONS = f"""
  SELECT CASE WHEN o_custkey < 40 THEN 'aza://new' ELSE 'aza://u' END || CAST(o_custkey AS VARCHAR) AS docid,
    'title ' || CAST(o_custkey AS VARCHAR) AS title, '{SITE}' || CAST(o_custkey AS VARCHAR) AS url,
    CAST(o_orderdate AS DATE) AS decision_date, 'search/' || CAST(o_orderkey AS VARCHAR) AS search_page_path
  FROM orders"""


def registry_latest(spark, sf_dir):
    return rg.registry_index(log(spark, sf_dir)).select("record_key", "docid", "url", "status", "raw_html_path", "line_no")


QUERIES["registry_latest"] = registry_latest
ORACLES["registry_latest"] = _INDEX


def latest_by_path(spark, sf_dir):
    return rg.registry_by_path(log(spark, sf_dir)).select("raw_html_path", "docid", "status", "line_no")


QUERIES["latest_by_path"] = latest_by_path
ORACLES["latest_by_path"] = f"""
  SELECT raw_html_path, docid, status, line_no FROM (
    SELECT *, row_number() OVER (PARTITION BY raw_html_path ORDER BY ts DESC, line_no DESC) AS rn
    FROM ({_LOG}) AS l WHERE raw_html_path <> '') AS r WHERE rn = 1"""


def status_predicates(spark, sf_dir):
    rows = log(spark, sf_dir)
    return rows.select(
        "line_no",
        rg.is_downloaded(F.col("status"), F.col("raw_html_path")).alias("downloaded"),
        rg.is_error(F.col("status")).alias("failed"),
    )


QUERIES["status_predicates"] = status_predicates
ORACLES["status_predicates"] = f"""
  SELECT line_no, coalesce(status IN ('downloaded', 'already_exists') AND raw_html_path <> '', FALSE) AS downloaded,
    status = 'error' AS failed FROM ({_LOG}) AS l"""


def existing_downloads(spark, sf_dir):
    index = rg.registry_index(log(spark, sf_dir))
    return rg.existing_downloads(index, listing(spark, sf_dir)).select("record_key", "raw_html_path", "status")


_EXISTING = f"""
  SELECT record_key, raw_html_path, status FROM ({_INDEX}) AS i
  WHERE status IN ('downloaded', 'already_exists') AND raw_html_path <> '' AND raw_html_path IN ({_LISTING})"""
QUERIES["existing_downloads"] = existing_downloads
ORACLES["existing_downloads"] = _EXISTING


def _plan(spark, sf_dir, retry):
    index = rg.registry_index(log(spark, sf_dir))
    plan = rg.download_plan(decisions(spark, sf_dir), index, listing(spark, sf_dir), retry_errors=retry)
    return plan.select("docid", "url", "title", "decision_date", "search_page_path")


_WANTED = f"""
  SELECT docid, title, url, decision_date, search_page_path FROM (
    SELECT *, row_number() OVER (PARTITION BY docid ORDER BY decision_date, search_page_path, url) AS rn
    FROM ({_DECISIONS}) AS d) AS r WHERE rn = 1"""


def _plan_sql(skip_errors: bool) -> str:
    errors = "OR coalesce(by_docid.status, by_url.status) = 'error'" if skip_errors else ""
    return f"""
      SELECT w.docid, w.url, w.title, w.decision_date, w.search_page_path
      FROM ({_WANTED}) AS w
      LEFT JOIN ({_INDEX}) AS by_docid ON by_docid.record_key = w.docid
      LEFT JOIN ({_INDEX}) AS by_url ON by_url.record_key = w.url
      WHERE NOT coalesce(coalesce(by_docid.record_key, by_url.record_key) IN (SELECT record_key FROM ({_EXISTING}) AS e)
        {errors}, FALSE)"""


QUERIES["download_plan"] = lambda spark, sf_dir: _plan(spark, sf_dir, retry=False)
ORACLES["download_plan"] = _plan_sql(skip_errors=True)
QUERIES["download_plan_retry"] = lambda spark, sf_dir: _plan(spark, sf_dir, retry=True)
ORACLES["download_plan_retry"] = _plan_sql(skip_errors=False)


def registry_rows(spark, sf_dir):
    """Log rows of a run: orders that went out fine are downloads, the others errors with a long message."""
    wanted = decisions(spark, sf_dir).withColumn("docid", F.col("search_page_path"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    docid = F.concat(F.lit("search/"), F.col("o_orderkey").cast("string")).alias("docid")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd").alias("scraped_at")
    good = orders.where("o_orderstatus <> 'P'").select(
        docid,
        F.when(F.col("o_orderstatus") == "F", "downloaded").otherwise("already_exists").alias("status"),
        F.when(F.col("o_orderstatus") == "F", 200).alias("http_status"),
        F.concat(F.lit("raw/"), F.col("o_orderkey").cast("string")).alias("raw_html_path"),
        F.sha2("o_orderpriority", 256).alias("content_hash"),
        stamp,
    )
    bad = orders.where("o_orderstatus = 'P'").select(docid, F.repeat("o_orderpriority", 400).alias("message"), stamp)
    return widen(rg.success_rows(wanted, good).unionByName(rg.error_rows(wanted, bad)))


QUERIES["registry_rows"] = registry_rows
ORACLES["registry_rows"] = f"""
  SELECT 'search/' || CAST(o_orderkey AS VARCHAR) AS docid, 'title ' || CAST(o_custkey AS VARCHAR) AS title,
    '{SITE}' || CAST(o_custkey AS VARCHAR) AS url,
    CASE o_orderstatus WHEN 'P' THEN 'error' WHEN 'F' THEN 'downloaded' ELSE 'already_exists' END AS status,
    CAST(CASE WHEN o_orderstatus = 'F' THEN 200 END AS BIGINT) AS http_status,
    CASE WHEN o_orderstatus <> 'P' THEN 'raw/' || CAST(o_orderkey AS VARCHAR) END AS raw_html_path,
    CASE WHEN o_orderstatus <> 'P' THEN sha256(o_orderpriority) END AS content_hash,
    strftime(o_orderdate, '%Y-%m-%d') AS decision_date, 'search/' || CAST(o_orderkey AS VARCHAR) AS search_page_path,
    strftime(o_orderdate, '%Y-%m-%d') AS scraped_at,
    CASE WHEN o_orderstatus = 'P' THEN left(repeat(o_orderpriority, 400), 2000) END AS error_message,
    'bger' AS source, 'de' AS language, 'BGer' AS court FROM orders"""


# --- incremental work ------------------------------------------------------


def registry_rows(rows):
    """Rows with the columns of the log; what they lack is NULL."""
    fields = [f for f in schemas.REGISTRY.fields if f.name != "batch_seq"]
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def _judged_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    return docs, done


def incremental_extract(spark, sf_dir):
    docs, done = _judged_documents(spark, sf_dir)
    return inc.pending(docs, done, "doc_id").select("doc_id", "lang", "n_chars")


QUERIES["incremental_extract"] = incremental_extract
ORACLES["incremental_extract"] = """
  SELECT doc_id, lang, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""


def incremental_annotate(spark, sf_dir):
    """Earlier records stay as they are, new ones are added for what was pending."""
    docs, done = _judged_documents(spark, sf_dir)
    earlier = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.lit("earlier").alias("run"), F.col("quality").cast("bigint").alias("value"))
    new = inc.pending(docs, done, "doc_id").select("doc_id", F.lit("new").alias("run"), F.col("n_chars").alias("value"))
    return inc.carry_forward(earlier, new)


QUERIES["incremental_annotate"] = incremental_annotate
ORACLES["incremental_annotate"] = """
  SELECT doc_id, 'earlier' AS run, CAST(quality AS BIGINT) AS value FROM labels
  UNION ALL
  SELECT doc_id, 'new' AS run, n_chars AS value FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""


def limit_pending(spark, sf_dir):
    """The first 25 pending documents by path; the limit is the feature."""
    docs, done = _judged_documents(spark, sf_dir)
    path = F.concat(F.lit("raw/"), F.col("doc_id").cast("string"), F.lit(".html"))
    todo = inc.pending(docs, done, "doc_id").withColumn("raw_html_path", path)
    return inc.limit_pending(todo, 25).select("doc_id", "raw_html_path")


QUERIES["limit_pending"] = limit_pending
ORACLES["limit_pending"] = """
  SELECT doc_id, 'raw/' || CAST(doc_id AS VARCHAR) || '.html' AS raw_html_path FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) ORDER BY raw_html_path LIMIT 25"""


# --- dates -----------------------------------------------------------------


def date_range(spark, sf_dir):
    """Every day between the first and last order of each status and priority."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    keys = ("o_orderstatus", "o_orderpriority")
    spans = orders.groupBy(*keys).agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    days = spans.select(*keys, F.explode(lk.days_between(F.col("a"), F.col("b"))).alias("day"))
    return days.select(*keys, "day", dates.format_day(F.col("day")).alias("written"))


QUERIES["date_range"] = date_range
ORACLES["date_range"] = """
  SELECT o_orderstatus, o_orderpriority, CAST(day AS DATE) AS day, strftime(day, '%d.%m.%Y') AS written
  FROM (SELECT o_orderstatus, o_orderpriority, unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS day
        FROM orders GROUP BY 1, 2) AS d"""

_FORMS = (
    "CASE k % 5 WHEN 0 THEN yyyy || '-' || mm || '-' || dd WHEN 1 THEN dd || '.' || mm || '.' || yyyy "
    "WHEN 2 THEN yyyy || '/' || mm || '/' || dd WHEN 3 THEN '31.02.' || yyyy ELSE yyyy || '-' || mm END"
)


def parse_two_formats(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    parts = orders.select(
        F.col("o_orderkey").alias("k"),
        *[F.date_format("o_orderdate", f).alias(f.lower()) for f in ("yyyy", "MM", "dd")],
    )
    written = parts.select("k", F.expr(_FORMS).alias("written"))
    return written.select("k", "written", dates.parse_day_argument(F.col("written")).alias("day"))


QUERIES["parse_two_formats"] = parse_two_formats
ORACLES["parse_two_formats"] = f"""
  SELECT k, written, CASE WHEN k % 5 IN (0, 1) THEN day END AS day
  FROM (SELECT k, {_FORMS} AS written, day
        FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y') AS yyyy,
                strftime(o_orderdate, '%m') AS mm, strftime(o_orderdate, '%d') AS dd FROM orders) AS p) AS w"""


def decision_year(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return widen(orders.select("o_orderkey", dates.year_of(text).alias("year")))


QUERIES["decision_year"] = decision_year
ORACLES["decision_year"] = "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) END AS year FROM orders"


def page_name_fields(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    path = pg.page_name("data/search_pages", F.to_date("o_orderdate"), F.col("o_custkey"))
    named = orders.select("o_orderkey", path.alias("path"))
    day, page = pg.page_name_fields(F.col("path"))
    return widen(named.select("o_orderkey", "path", day.alias("day"), page.alias("page")))


QUERIES["page_name_fields"] = page_name_fields
ORACLES["page_name_fields"] = """
  SELECT o_orderkey, 'data/search_pages/search_' || strftime(o_orderdate, '%d.%m.%Y') || '_' || strftime(o_orderdate, '%d.%m.%Y')
    || '_page_' || CAST(o_custkey AS VARCHAR) || '.html' AS path, CAST(o_orderdate AS DATE) AS day, o_custkey AS page FROM orders"""
