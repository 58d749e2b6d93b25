"""Text and array primitives on the documents table, over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavelframe.functions import codebook as cb
from gavelframe.functions import text as tx
from gavelframe.operators import coding
from gavelframe.session import use_all_cores
from workloads.coding_queries import widen
from workloads.judgments import q
from workloads.page_queries import squeeze_sql

QUERIES = {}
ORACLES = {}


def documents(spark, sf_dir):
    table = use_all_cores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return table.withColumn("paragraphs", F.split("text", "\n"))


_PARAGRAPHS = "string_split(text, chr(10))"


def fold_sql(text: str) -> str:
    return f"replace(lower({squeeze_sql(text)}), 'ß', 'ss')"


def any_sql(text: str, terms) -> str:
    return "(" + " OR ".join(f"contains({text}, {q(t)})" for t in terms) + ")"


def rules_sql(text: str, rules) -> str:
    return "(CASE " + " ".join(f"WHEN {any_sql(text, terms)} THEN {q(label)}" for label, terms in rules) + " END)"


def fold_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", tx.fold(F.col("text")).alias("folded"))


QUERIES["fold_text"] = fold_text
ORACLES["fold_text"] = f"SELECT doc_id, {fold_sql('text')} AS folded FROM documents"


def first_match(spark, sf_dir):
    rows = documents(spark, sf_dir)
    return rows.select(
        "doc_id",
        tx.first_match(tx.head(F.col("paragraphs"), 12), "([a-z]{9,}),").alias("in_head"),
        tx.first_match(F.col("paragraphs"), "([0-9]{3,})").alias("number"),
    )


QUERIES["first_match"] = first_match
ORACLES["first_match"] = f"""
  SELECT doc_id, nullif(regexp_extract(array_to_string(({_PARAGRAPHS})[1:12], chr(10)), '([a-z]{{9,}}),', 1), '') AS in_head,
    nullif(regexp_extract(text, '([0-9]{{3,}})', 1), '') AS number FROM documents"""


def array_slices(spark, sf_dir):
    rows = documents(spark, sf_dir)
    p = F.col("paragraphs")
    return rows.select(
        "doc_id",
        F.array_join(tx.head(p, 8), "|").alias("first_8"),
        F.array_join(tx.tail(p, 18), "|").alias("last_18"),
        F.array_join(tx.after(p, F.lit(2), 3), "|").alias("third_to_fifth"),
    )


QUERIES["array_slices"] = array_slices
ORACLES["array_slices"] = f"""
  SELECT doc_id, array_to_string(p[1:8], '|') AS first_8, array_to_string(p[greatest(1, len(p) - 17):len(p)], '|') AS last_18,
    array_to_string(p[3:5], '|') AS third_to_fifth FROM (SELECT doc_id, {_PARAGRAPHS} AS p FROM documents) AS d"""


def split_first(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumn("parts", tx.split_once(F.col("text"), " (?:the|der|les|los) "))
    return rows.select("doc_id", F.get("parts", 0).alias("before"), F.get("parts", 1).alias("rest"))


QUERIES["split_first"] = split_first
ORACLES["split_first"] = """
  SELECT doc_id, before, CASE WHEN hit <> '' THEN substr(text, length(before) + length(hit) + 1) END AS rest
  FROM (SELECT doc_id, text, regexp_extract(text, '(?i) (?:the|der|les|los) ') AS hit,
          regexp_split_to_array(text, '(?i) (?:the|der|les|los) ')[1] AS before FROM documents) AS d"""


def find_all(spark, sf_dir):
    rows = documents(spark, sf_dir)
    found = tx.capture_all(F.col("text"), "([A-Z][a-z]{3,})[,. ]", 1)
    listed = rows.select("doc_id", found.alias("found"))
    return widen(listed.select("doc_id", F.size("found").alias("n"), F.array_join("found", ";").alias("words")))


QUERIES["find_all"] = find_all
ORACLES["find_all"] = """
  SELECT doc_id, CAST(len(found) AS BIGINT) AS n, array_to_string(found, ';') AS words
  FROM (SELECT doc_id, regexp_extract_all(text, '([A-Z][a-z]{3,})[,. ]', 1) AS found FROM documents) AS d"""


def any_substring(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumn("folded", tx.fold(F.col("text")))
    return rows.select(
        "doc_id",
        tx.contains_any(F.col("folded"), cb.STATE_TERMS).alias("state_term"),
        tx.contains_any(F.concat(F.lit(" "), "folded", F.lit(" ")), cb.LAWYER_TERMS).alias("lawyer_term"),
    )


QUERIES["any_substring"] = any_substring
ORACLES["any_substring"] = f"""
  SELECT doc_id, {any_sql('folded', cb.STATE_TERMS)} AS state_term,
    {any_sql("(' ' || folded || ' ')", cb.LAWYER_TERMS)} AS lawyer_term
  FROM (SELECT doc_id, {fold_sql('text')} AS folded FROM documents) AS d"""


def first_hit_rules(spark, sf_dir):
    """The ordered rule tables over whole documents, where hits are accidental."""
    rows = documents(spark, sf_dir).withColumn("folded", tx.fold(F.col("text")))
    return rows.select(
        "doc_id",
        coding.area_detailed(F.col("folded")).alias("area"),
        coding.source_canton(F.col("folded")).alias("canton"),
        tx.first_hit(F.col("folded"), cb.LANGUAGE_MARKERS).alias("language"),
        coding.outcome(F.col("folded")).alias("outcome"),
    )


QUERIES["first_hit_rules"] = first_hit_rules
ORACLES["first_hit_rules"] = f"""
  SELECT doc_id, {rules_sql('folded', cb.AREA_TERMS.items())} AS area,
    {rules_sql('folded', [(cb.FEDERAL_SOURCE, cb.FEDERAL_SOURCE_TERMS), *cb.CANTON_TERMS.items()])} AS canton,
    {rules_sql('folded', cb.LANGUAGE_MARKERS)} AS language, {rules_sql('folded', cb.OUTCOME_TERMS)} AS outcome
  FROM (SELECT doc_id, {fold_sql('text')} AS folded FROM documents) AS d"""


def text_prefix(spark, sf_dir):
    """Leading characters; the cut is the feature."""
    rows = documents(spark, sf_dir)
    return rows.select("doc_id", *[tx.prefix(F.col("text"), n).alias(f"first_{n}") for n in (160, 1000, 3000)])


QUERIES["text_prefix"] = text_prefix
ORACLES["text_prefix"] = (
    "SELECT doc_id, left(text, 160) AS first_160, left(text, 1000) AS first_1000, left(text, 3000) AS first_3000 FROM documents"
)


def strip_chars(spark, sf_dir):
    rows = documents(spark, sf_dir)
    return rows.select(
        "doc_id",
        F.rtrim(F.col("text"), F.lit(",.;")).alias("right"),
        F.btrim(F.col("text"), F.lit(" .:;")).alias("both"),
        tx.strip_blanks(F.concat(F.lit("\xa0\t"), F.col("text"), F.lit(" \n"))).alias("blanks"),
    )


QUERIES["strip_chars"] = strip_chars
ORACLES["strip_chars"] = r"""
  SELECT doc_id, rtrim(text, ',.;') AS right, trim(text, ' .:;') AS both,
    regexp_replace(regexp_replace(text, '^[\s\x0b\x{a0}]+', ''), '[\s\x0b\x{a0}]+$', '') AS blanks FROM documents"""


def document_sections(spark, sf_dir):
    """Holdings, language and outcome of whole documents read as judgments."""
    docs = documents(spark, sf_dir)
    judgments = docs.select(
        F.col("doc_id").cast("string").alias("html_id"), F.lit("raw/x.html").alias("raw_html_path"), "paragraphs", "text"
    )
    keep = ("html_id", "language", "length", "outcome", "area_detailed", "merged_cases")
    return widen(coding.annotate(coding.without_registry(judgments), keep=keep))


_OPENING = f"replace(lower(array_to_string(p[1:20], chr(10))), 'ß', 'ss')"
_LOWERED = f"[{fold_sql('x')} FOR x IN p]"
_MARKED = f"list_position([{any_sql('f', cb.HOLDING_MARKERS)} FOR f IN {_LOWERED}], TRUE)"
_HOLDINGS = f"array_to_string(p[coalesce(nullif({_MARKED}, 0), greatest(1, len(p) - 17)):len(p)], ' ')"
QUERIES["document_sections"] = document_sections
ORACLES["document_sections"] = f"""
  SELECT CAST(doc_id AS VARCHAR) AS html_id, {rules_sql(_OPENING, cb.LANGUAGE_MARKERS)} AS language,
    CAST(length(text) AS BIGINT) AS length, {rules_sql('held', cb.OUTCOME_TERMS)} AS outcome,
    {rules_sql('head', cb.AREA_TERMS.items())} AS area_detailed,
    regexp_matches(array_to_string(p[1:8], ' '), '[1-9][A-Z][_.][0-9]+/[0-9]{{4}}') AS merged_cases
  FROM (SELECT doc_id, text, p, {fold_sql(_HOLDINGS)} AS held, {fold_sql('left(text, 3000)')} AS head
        FROM (SELECT doc_id, text, {_PARAGRAPHS} AS p FROM documents) AS d) AS e"""
