"""Pages, links, and paths on the pages and documents tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavelframe.functions import html as hx
from gavelframe.functions import text as tx
from gavelframe.functions.html import ARTICLE_LAYOUT, COURT_LAYOUT
from gavelframe.operators import extraction as ex
from gavelframe.operators import incremental as inc
from gavelframe.operators import links as lk
from gavelframe.session import use_all_cores
from gavelframe.sources import pages as pg
from gavelframe.sources import paths
from workloads.coding_queries import widen

QUERIES = {}
ORACLES = {}

RAW = "data/raw/judgments"
INTERIM = "data/interim/judgments_extracted"
CODED = "data/interim/judgment_annotations"

# White space as both engines must see it, spelled out for RE2.
BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def squeeze_sql(text: str) -> str:
    return f"trim(regexp_replace({text}, '{BLANKS}', ' ', 'g'))"


def unescape_sql(text: str) -> str:
    for entity, char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


def fragment_sql(markup: str) -> str:
    return squeeze_sql(unescape_sql(f"regexp_replace({markup}, '<[^>]*>', ' ', 'g')"))


def pages(spark, sf_dir):
    """The pages table with the path each page would have on disk."""
    table = use_all_cores(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return table.withColumn("raw_html_path", paths.digest_path(RAW, F.lit(""), F.col("url")))


_DIGEST = "substr(sha256(url), 1, 16)"
_PATH = f"'{RAW}/' || substr(sha256(url), 1, 2) || '/' || {_DIGEST} || '.html'"
_CONTAINER = "regexp_extract(html, '(?s)<article>(.*)</article>', 1)"
_BLOCKS = (
    f"[t FOR t IN [{fragment_sql('split_part(b, ' + chr(39) + '</p>' + chr(39) + ', 1)')} "
    f"FOR b IN string_split({_CONTAINER}, '<p>')[2:]] IF t <> '']"
)


def scan_pages(spark, sf_dir):
    rows = pages(spark, sf_dir)
    return widen(rows.select("page_id", "raw_html_path", F.length("html").alias("n_chars")))


QUERIES["scan_pages"] = scan_pages
ORACLES["scan_pages"] = (
    f"SELECT page_id, {_PATH} AS raw_html_path, CAST(length(html) AS BIGINT) AS n_chars FROM pages"
)


def digest_path(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    docid = F.when(F.contains("url", F.lit("?")), F.concat(F.lit("aza://"), F.col("page_id").cast("string"))).otherwise("")
    return table.select(
        "page_id",
        paths.digest(docid, F.col("url")).alias("digest"),
        paths.digest_path(RAW, docid, F.col("url")).alias("path"),
    )


_KEY = "CASE WHEN contains(url, '?') THEN 'aza://' || CAST(page_id AS VARCHAR) ELSE url END"
QUERIES["digest_path"] = digest_path
ORACLES["digest_path"] = (
    f"SELECT page_id, substr(sha256({_KEY}), 1, 16) AS digest, "
    f"'{RAW}/' || substr(sha256({_KEY}), 1, 2) || '/' || substr(sha256({_KEY}), 1, 16) || '.html' AS path FROM pages"
)


def content_hash(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", paths.content_hash(F.col("html").cast("binary")).alias("content_hash"))


QUERIES["content_hash"] = content_hash
ORACLES["content_hash"] = "SELECT page_id, sha256(html) AS content_hash FROM pages"


def path_mapping(spark, sf_dir):
    rows = pages(spark, sf_dir)
    extracted = paths.extracted_path(F.col("raw_html_path"), RAW, INTERIM)
    return rows.select(
        "page_id",
        extracted.alias("extracted_path"),
        paths.annotation_path(extracted, INTERIM, CODED).alias("annotation_path"),
        paths.file_stem(F.col("raw_html_path")).alias("stem"),
        paths.shard(F.col("raw_html_path")).alias("shard"),
    )


QUERIES["path_mapping"] = path_mapping
ORACLES["path_mapping"] = f"""
  SELECT page_id, '{INTERIM}/' || substr({_DIGEST}, 1, 2) || '/' || {_DIGEST} || '.json' AS extracted_path,
    '{CODED}/' || substr({_DIGEST}, 1, 2) || '/' || {_DIGEST} || '.json' AS annotation_path,
    {_DIGEST} AS stem, substr({_DIGEST}, 1, 2) AS shard FROM pages"""


# Text that each multi-byte charset can hold, as characters and as its bytes there.
_FOREIGN = {"shift_jis": "cp932", "gbk": "gb18030", "big5": "big5hkscs", "euc-kr": "cp949"}
_SAMPLES = {"shift_jis": "判決の理由", "gbk": "判决理由书", "big5": "判決理由書", "euc-kr": "판결 이유"}


def decode_pages(spark, sf_dir):
    """Pages as bytes in eight encodings; decoding must give the text back.

    In the multi-byte ones, which this engine does not write, the ASCII part of a
    page is followed by a sentence in their script.
    """
    rows = pages(spark, sf_dir).withColumn("form", F.col("page_id") % 8)
    latin = F.replace("html", F.lit('charset="utf-8"'), F.lit('charset="iso-8859-1"'))
    content = (
        F.when(F.col("form") == 0, F.encode(F.col("html"), "UTF-8"))
        .when(F.col("form") == 1, F.encode(F.col("html"), "ISO-8859-1"))
        .when(F.col("form") == 2, F.encode(latin, "ISO-8859-1"))
        .when(F.col("form") == 3, F.concat(F.unhex(F.lit("EFBBBF")), F.encode(F.col("html"), "UTF-8")))
    )
    for k, (name, codec) in enumerate(_FOREIGN.items()):
        ascii_only = F.regexp_replace(F.replace("html", F.lit('charset="utf-8"'), F.lit(f'charset="{name}"')), r"[^\x00-\x7F]", "?")
        sample = F.unhex(F.lit(_SAMPLES[name].encode(codec).hex()))
        content = content.when(F.col("form") == 4 + k, F.concat(F.encode(ascii_only, "US-ASCII"), sample))
    text = pg.decode_page(F.col("content"))
    return rows.withColumn("content", content).select("page_id", F.sha2(text, 256).alias("decoded"))


QUERIES["decode_pages"] = decode_pages
ORACLES["decode_pages"] = (
    "SELECT page_id, sha256(CASE page_id % 8 WHEN 2 THEN replace(html, 'charset=\"utf-8\"', 'charset=\"iso-8859-1\"') "
    + " ".join(
        f"WHEN {4 + k} THEN regexp_replace(replace(html, 'charset=\"utf-8\"', 'charset=\"{name}\"'), '[^\\x00-\\x7F]', '?', 'g') || '{_SAMPLES[name]}'"
        for k, name in enumerate(_FOREIGN)
    )
    + " ELSE html END) AS decoded FROM pages"
)


def normalize_text(spark, sf_dir):
    rows = pages(spark, sf_dir)
    return rows.select("page_id", tx.squeeze(F.replace("html", F.lit("&nbsp;"), F.lit("\xa0"))).alias("normalized"))


QUERIES["normalize_text"] = normalize_text
ORACLES["normalize_text"] = (
    f"SELECT page_id, {squeeze_sql('replace(html, ' + chr(39) + '&nbsp;' + chr(39) + ', chr(160))')} AS normalized FROM pages"
)


def html_container(spark, sf_dir):
    return ex.with_container(pages(spark, sf_dir), ARTICLE_LAYOUT).select("page_id", "container")


QUERIES["html_container"] = html_container
ORACLES["html_container"] = f"SELECT page_id, {_CONTAINER} AS container FROM pages"


def html_paragraphs(spark, sf_dir):
    rows = ex.with_paragraphs(ex.with_container(pages(spark, sf_dir), ARTICLE_LAYOUT), ARTICLE_LAYOUT)
    numbered = rows.select("page_id", F.posexplode("paragraphs").alias("position", "paragraph"))
    return widen(numbered)


QUERIES["html_paragraphs"] = html_paragraphs
ORACLES["html_paragraphs"] = f"""
  SELECT page_id, CAST(i - 1 AS BIGINT) AS position, blocks[i] AS paragraph
  FROM (SELECT page_id, blocks, unnest(range(1, len(blocks) + 1)) AS i
        FROM (SELECT page_id, {_BLOCKS} AS blocks FROM pages) AS b) AS n"""


def html_text(spark, sf_dir):
    rows = ex.with_paragraphs(ex.with_container(pages(spark, sf_dir), ARTICLE_LAYOUT), ARTICLE_LAYOUT)
    return rows.select("page_id", F.trim(F.array_join("paragraphs", "\n")).alias("text"))


QUERIES["html_text"] = html_text
ORACLES["html_text"] = f"SELECT page_id, array_to_string({_BLOCKS}, chr(10)) AS text FROM pages"


def extract_record(spark, sf_dir):
    rows = ex.extract_pages(pages(spark, sf_dir), ARTICLE_LAYOUT)
    return widen(rows.select("html_id", "raw_html_path", "extraction_version", "selector", "paragraph_selector", "text", "paragraph_count", "char_count"))


QUERIES["extract_record"] = extract_record
ORACLES["extract_record"] = f"""
  SELECT {_DIGEST} AS html_id, {_PATH} AS raw_html_path, 'v1' AS extraction_version, 'article' AS selector,
    'p' AS paragraph_selector, array_to_string(blocks, chr(10)) AS text, CAST(len(blocks) AS BIGINT) AS paragraph_count,
    CAST(length(array_to_string(blocks, chr(10))) AS BIGINT) AS char_count
  FROM (SELECT url, {_BLOCKS} AS blocks FROM pages) AS b"""


# --- court pages written from documents ------------------------------------


def court_pages(spark, sf_dir):
    """Documents as court pages: one block per line, escaped; a third of the languages has no container."""
    docs = use_all_cores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    blocks = F.replace(escaped, F.lit("\n"), F.lit('&nbsp;</div>\n<div class="para">'))
    body = F.concat(F.lit('<div class="box" id="highlight_content"><div>menu</div>\n<div class="content"><div class="para">'), blocks, F.lit("</div></div></div>"))
    inner = F.when(F.col("lang") == "es", F.concat(F.lit("<main>"), escaped, F.lit("</main>"))).otherwise(body)
    html = F.concat(F.lit("<html><body><div>Kopf</div>"), inner, F.lit('<div class="para">Fuss</div></body></html>'))
    return docs.select("doc_id", "lang", F.concat(F.lit(f"{RAW}/"), F.col("doc_id").cast("string"), F.lit(".html")).alias("raw_html_path"), html.alias("html"))


_LINES = f"[t FOR t IN [{squeeze_sql('x')} FOR x IN string_split(text, chr(10))] IF t <> '']"


def court_extraction(spark, sf_dir):
    good, _ = inc.split_failed(ex.extract_pages(court_pages(spark, sf_dir), COURT_LAYOUT))
    return widen(good.select("html_id", "text", "paragraph_count", "char_count"))


QUERIES["court_extraction"] = court_extraction
ORACLES["court_extraction"] = f"""
  SELECT CAST(doc_id AS VARCHAR) AS html_id, array_to_string(lines, chr(10)) AS text,
    CAST(len(lines) AS BIGINT) AS paragraph_count, CAST(length(array_to_string(lines, chr(10))) AS BIGINT) AS char_count
  FROM (SELECT doc_id, {_LINES} AS lines FROM documents WHERE lang <> 'es') AS d"""


def quarantine(spark, sf_dir):
    _, bad = inc.split_failed(ex.extract_pages(court_pages(spark, sf_dir), COURT_LAYOUT))
    return bad.select("raw_html_path", "error_message")


QUERIES["quarantine"] = quarantine
ORACLES["quarantine"] = f"""
  SELECT '{RAW}/' || CAST(doc_id AS VARCHAR) || '.html' AS raw_html_path,
    'Could not find judgment content: #highlight_content > .content' AS error_message
  FROM documents WHERE lang = 'es'"""


def nested_blocks(spark, sf_dir):
    """Documents as one block in as many nested elements as the id says (0 to 59), with a marked inner block."""
    docs = use_all_cores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    depth = (F.col("doc_id") % 60).cast("int")
    line = F.replace(F.replace(F.split("text", "\n")[0], F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    html = F.concat(
        F.lit('<section id="highlight_content"><p class="content" title="a > b"><div class="para">'),
        F.repeat(F.lit("<div>"), depth), line, F.lit('<div class="para">mark</div>'), F.repeat(F.lit("</div>"), depth),
        F.lit('</div></p></section><div class="para">out</div>'),
    )
    pages = docs.select(F.concat(F.lit("x/"), F.col("doc_id").cast("string"), F.lit(".html")).alias("raw_html_path"), html.alias("html"))
    rows = ex.extract_pages(pages, COURT_LAYOUT)
    return rows.select("html_id", F.get("paragraphs", F.lit(0)).alias("outer_block"), F.get("paragraphs", F.lit(1)).alias("inner_block"), F.size("paragraphs").cast("long").alias("n"))


QUERIES["nested_blocks"] = nested_blocks
ORACLES["nested_blocks"] = f"""
  SELECT CAST(doc_id AS VARCHAR) AS html_id, {squeeze_sql("split_part(text, chr(10), 1) || ' mark'")} AS outer_block,
    'mark' AS inner_block, CAST(2 AS BIGINT) AS n FROM documents"""


def run_counters(spark, sf_dir):
    rows = ex.extract_pages(court_pages(spark, sf_dir), COURT_LAYOUT)
    status = F.when(F.col("error_message").isNull(), "processed").otherwise("failed")
    return inc.run_counters(rows, status)


QUERIES["run_counters"] = run_counters
ORACLES["run_counters"] = """
  SELECT CASE WHEN lang = 'es' THEN 'failed' ELSE 'processed' END AS status, count(*) AS n FROM documents GROUP BY 1"""


# --- links -----------------------------------------------------------------

_QUERY = "?type=show_document&amp;highlight_docid=aza%3A%2F%2F"


def search_pages(spark, sf_dir):
    """The pages with their links turned into decision links."""
    table = use_all_cores(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return table.withColumn("html", F.replace("html", F.lit('href="/'), F.lit(f'href="{_QUERY}')))


_ANCHORS = r"""
  SELECT page_id, url AS base, i - 1 AS position, hrefs[i] AS href, titles[i] AS title
  FROM (SELECT page_id, url, hrefs, titles, unnest(range(1, len(hrefs) + 1)) AS i
        FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="/([^"]*)">[^<]*</a>', 1) AS hrefs,
                regexp_extract_all(html, '<a href="/[^"]*">([^<]*)</a>', 1) AS titles FROM pages) AS p) AS n"""
_LINKS = rf"""
  SELECT page_id, CAST(position AS BIGINT) AS position, {fragment_sql('title')} AS title,
    regexp_replace(base, '[?#].*$', '') || '?type=show_document&highlight_docid=aza%3A%2F%2F' || {unescape_sql('href')} AS url,
    'aza://' || regexp_extract({unescape_sql('href')}, '^[^&#]*') AS docid
  FROM ({_ANCHORS}) AS a WHERE NOT contains(lower({fragment_sql('title')}), 'the')"""


def _links(spark, sf_dir):
    return lk.page_links(search_pages(spark, sf_dir).withColumnRenamed("url", "base"), F.col("base"), dropped_title="the")


def page_links(spark, sf_dir):
    return widen(_links(spark, sf_dir).select("page_id", "position", "title", "url", "docid"))


QUERIES["page_links"] = page_links
ORACLES["page_links"] = _LINKS


def links_first_wins(spark, sf_dir):
    first = lk.first_link_wins(_links(spark, sf_dir), ["page_id"])
    return widen(first.select("page_id", "docid", "position", "title", "url"))


QUERIES["links_first_wins"] = links_first_wins
ORACLES["links_first_wins"] = f"""
  SELECT page_id, docid, position, title, url
  FROM (SELECT *, row_number() OVER (PARTITION BY page_id, docid ORDER BY position) AS rn FROM ({_LINKS}) AS l) AS r
  WHERE rn = 1"""


def contiguous_pages(spark, sf_dir):
    """Days of the event log as search days, hours as result pages; an hour with an error has no links."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    hours = events.select(
        F.to_date("ts").alias("day"), (F.hour("ts") + 1).alias("page"), (F.col("event_type") == "error").alias("failed")
    )
    listed = hours.groupBy("day", "page").agg((~F.max("failed")).alias("has_links"))
    return widen(lk.contiguous_pages(listed, "day", "page", F.col("has_links"), 24).select("day", "page"))


QUERIES["contiguous_pages"] = contiguous_pages
ORACLES["contiguous_pages"] = """
  SELECT day, page FROM (
    SELECT day, page, bool_and(ok) OVER w AS linked, row_number() OVER w AS rn
    FROM (SELECT CAST(ts AS DATE) AS day, hour(ts) + 1 AS page, NOT bool_or(event_type = 'error') AS ok
          FROM events GROUP BY 1, 2) AS h
    WINDOW w AS (PARTITION BY day ORDER BY page)) AS c
  WHERE linked AND page = rn"""
