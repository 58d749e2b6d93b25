"""Coding rules on the judgments written from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelframe.functions import codebook as cb
from gavelframe.functions import dates
from gavelframe.functions import text as tx
from gavelframe.operators import coding, replies
from workloads.judgments import (
    EXPECTED,
    LINES,
    expected_sql,
    judgment_view,
    q,
    registry_log,
    written,
    written_sql,
)

QUERIES = {}
ORACLES = {}


def widen(df: DataFrame) -> DataFrame:
    """32-bit integers as BIGINT, so both engines show the same type."""
    return df.select(
        *[
            F.col(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, T.IntegerType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def coded(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Judgments coded by the rules: the named columns, or all."""
    keep = ["html_id", *columns] if columns else None
    return coding.annotate(judgment_view(spark, sf_dir), keep=keep)


def _columns(name: str, *columns: str) -> None:
    """Register some codebook columns against their closed form."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return widen(coded(spark, sf_dir, *columns))

    QUERIES[name] = run
    ORACLES[name] = expected_sql(*columns)


_columns("docref", "docref")
_columns("language", "language")
_columns("proc_type", "proc_type")
_columns("division", "division", "division_type")
_columns("decision_date", "date", "year")
_columns("source_date", "source_date")
_columns("source_canton", "source_canton")
_columns("proc_duration", "proc_duration")
_columns("issue_topic", "issue", "topic")
_columns("merged_cases", "merged_cases")
_columns("parties", "parties")
_columns("party_class", "app_class", "resp_class")
_columns("represented", "app_represented", "resp_represented")
_columns("outcome", "outcome", "outcome_binary")
_columns("citations", "cited_bger", "n_cited_bger", "cited_bge", "n_cited_bge")
_columns("leading_case", "leading_case")
_columns("area", "area_detailed", "area_intermediate", "area_general")


def judges(spark, sf_dir):
    rows = coded(spark, sf_dir, "n_judges", "judge_names")
    return widen(rows.withColumn("judge_names", F.array_join("judge_names", ";")))


QUERIES["judges"] = judges
ORACLES["judges"] = expected_sql("n_judges", "judge_names")


def warnings(spark, sf_dir):
    return coded(spark, sf_dir, "warnings").withColumn("warnings", F.array_join("warnings", ";"))


QUERIES["warnings"] = warnings
ORACLES["warnings"] = expected_sql("warnings")


def base_annotation(spark, sf_dir):
    rows = coded(spark, sf_dir, *cb.CODEBOOK_COLUMNS, "warnings", "judge_names")
    flat = rows.withColumns(
        {"warnings": F.array_join("warnings", ";"), "judge_names": F.array_join("judge_names", ";")}
    )
    return widen(flat.select("html_id", *cb.CODEBOOK_COLUMNS, "warnings", "judge_names"))


QUERIES["base_annotation"] = base_annotation
ORACLES["base_annotation"] = expected_sql(*cb.CODEBOOK_COLUMNS, "warnings", "judge_names")

_PRESENT = f"[x FOR x IN [{', '.join(LINES)}] IF x IS NOT NULL]"
_HOLDINGS = (
    "replace(CASE WHEN has_marker THEN concat_ws(' ', p22, p23, p24) "
    f"ELSE array_to_string(list_slice({_PRESENT}, greatest(1, len({_PRESENT}) - 17), len({_PRESENT})), ' ') END, '  ', ' ')"
)


def holdings(spark, sf_dir):
    rows = judgment_view(spark, sf_dir)
    folded = rows.withColumn("folded", F.transform("paragraphs", tx.fold))
    return folded.select("html_id", coding.holdings(F.col("paragraphs"), F.col("folded")).alias("holdings"))


QUERIES["holdings"] = holdings
ORACLES["holdings"] = f"SELECT html_id, {_HOLDINGS} AS holdings FROM ({written_sql()}) AS w"


def evidence_map(spark, sf_dir):
    rows = coded(spark, sf_dir, "evidence")
    return rows.select("html_id", *[F.element_at("evidence", k).alias(k) for k in ("issue", "parties", "outcome")])


QUERIES["evidence_map"] = evidence_map
ORACLES["evidence_map"] = (
    f"SELECT html_id, {EXPECTED['issue']} AS issue, {EXPECTED['parties']} AS parties, "
    f"CASE WHEN oc < 5 THEN left({_HOLDINGS}, 1000) END AS outcome FROM ({written_sql()}) AS w"
)


def enrich_registry(spark, sf_dir):
    extracted = judgment_view(spark, sf_dir).select(*coding.INPUTS)
    rows = coding.enrich(extracted, registry_log(spark, sf_dir))
    return rows.select("html_id", *[f"reg_{c}" for c in coding.REGISTRY_INPUTS])


QUERIES["enrich_registry"] = enrich_registry
ORACLES["enrich_registry"] = (
    f"SELECT html_id, reg_docid, reg_url, reg_decision_date, reg_language FROM ({written_sql()}) AS w"
)


def annotate_from_log(spark, sf_dir):
    """The whole way: pages coded, registry log reduced and joined, records finished."""
    extracted = judgment_view(spark, sf_dir).select(*coding.INPUTS)
    keep = ("html_id", "docref", "url", "date", "division", "proc_duration", "merged_cases", "cited_bger", "language")
    return widen(coding.annotate_with_log(extracted, registry_log(spark, sf_dir), keep=keep))


QUERIES["annotate_from_log"] = annotate_from_log
ORACLES["annotate_from_log"] = expected_sql(
    "docref", "url", "date", "division", "proc_duration", "merged_cases", "cited_bger", "language"
)


# --- arrays and dates on the same judgments --------------------------------


def marker_index(spark, sf_dir):
    rows = judgment_view(spark, sf_dir)
    keys = rows.withColumn("keys", F.transform("paragraphs", lambda p: tx.marker_key(tx.fold(p))))
    return keys.select(
        "html_id",
        *[
            tx.first_position(F.col("keys"), markers).cast("bigint").alias(name)
            for name, markers in (
                ("composition", cb.COMPOSITION_MARKERS),
                ("parties", cb.PARTY_MARKERS),
                ("subject", cb.SUBJECT_MARKERS),
            )
        ],
    )


def _rank(line: str) -> str:
    """Position of a line among the lines that are present."""
    earlier = LINES[: LINES.index(line) + 1]
    count = " + ".join(f"CASE WHEN {x} IS NULL THEN 0 ELSE 1 END" for x in earlier)
    return f"CAST(CASE WHEN {line} IS NOT NULL THEN {count} END AS BIGINT)"


QUERIES["marker_index"] = marker_index
ORACLES["marker_index"] = (
    f"SELECT html_id, {_rank('p06')} AS composition, {_rank('p10')} AS parties, {_rank('p16')} AS subject "
    f"FROM ({written_sql()}) AS w"
)


def block_take_while(spark, sf_dir):
    rows = coding.with_sections(judgment_view(spark, sf_dir))
    return rows.select("html_id", F.array_join("_composition", " | ").alias("composition"))


QUERIES["block_take_while"] = block_take_while
ORACLES["block_take_while"] = (
    f"SELECT html_id, CASE WHEN nj > 0 THEN concat_ws(' | ', p07, p08, p09) END AS composition FROM ({written_sql()}) AS w"
)


def parse_date_text(spark, sf_dir):
    rows = written(spark, sf_dir)
    return rows.select(
        "html_id",
        dates.parse_date_text(F.col("p04")).alias("decided"),
        dates.parse_date_text(F.col("p18")).alias("source_day"),
    )


QUERIES["parse_date_text"] = parse_date_text
ORACLES["parse_date_text"] = f"""
  SELECT html_id, CASE WHEN has_date THEN decided END AS decided,
    CASE WHEN df < 2 THEN source_day WHEN has_tail THEN CAST(decided + 5 AS DATE) END AS source_day
  FROM ({written_sql()}) AS w"""


def find_dates(spark, sf_dir):
    rows = written(spark, sf_dir)
    found = dates.find_dates(F.concat_ws(" ", "p04", "p18"))
    return rows.select("html_id", F.array_join(F.transform(found, dates.iso), ";").alias("found"))


QUERIES["find_dates"] = find_dates
ORACLES["find_dates"] = f"""
  SELECT html_id, concat_ws(';', CASE WHEN df = 1 THEN CAST(source_day AS VARCHAR) END,
    CASE WHEN has_date THEN CAST(decided AS VARCHAR) END,
    CASE WHEN df = 0 THEN CAST(source_day AS VARCHAR) END,
    CASE WHEN has_tail THEN CAST(CAST(decided + 5 AS DATE) AS VARCHAR) END) AS found
  FROM ({written_sql()}) AS w"""


# --- prompts and replies ---------------------------------------------------

_AMBIGUOUS = "(ar = 24 OR oc = 5 OR NOT has_parties)"
_REPLY_FORMS = [
    '{"area_detailed": "Vertragsrecht", "app_class": "legal", "resp_class": "natural", "outcome": "granted", '
    '"confidence": 0.5, "evidence": "short evidence"}',
    "{}",
    "no answer",
    '{"outcome": "granted", "confidence": 1.5}',
    '{"outcome": "rejected", "confidence": 1}',
    '{"outcome": 7, "confidence": 0.5}',
    "[1, 2]",
    '{"outcome": null, "app_class": "state", "confidence": 0.25, "evidence": null}',
    '{"confidence": null}',
]
_REPLY = "(CASE k % 9 " + " ".join(f"WHEN {i} THEN {q(f)}" for i, f in enumerate(_REPLY_FORMS)) + " END)"
_REPLY_ERROR = (
    "(CASE k % 9 WHEN 2 THEN 'reply is not a JSON object' WHEN 3 THEN 'confidence is outside 0..1' "
    "WHEN 5 THEN 'not text: outcome' WHEN 6 THEN 'reply is not a JSON object' WHEN 8 THEN 'confidence is not a number' END)"
)
_R_AREA = "(CASE WHEN k % 9 = 0 THEN 'Vertragsrecht' END)"
_R_APP = "(CASE k % 9 WHEN 0 THEN 'legal' WHEN 7 THEN 'state' END)"
_R_RESP = "(CASE WHEN k % 9 = 0 THEN 'natural' END)"
_R_OUTCOME = "(CASE k % 9 WHEN 0 THEN 'granted' WHEN 4 THEN 'rejected' END)"
_R_CONFIDENCE = "(CASE k % 9 WHEN 0 THEN 0.5 WHEN 1 THEN 0.0 WHEN 4 THEN 1.0 WHEN 7 THEN 0.25 END)"


def reply_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"))
    return rows.select(F.col("k").cast("string").alias("html_id"), F.expr(_REPLY).alias("reply"))


def ambiguous_rows(spark, sf_dir):
    return replies.ambiguous_rows(coded(spark, sf_dir, *cb.AMBIGUOUS_FIELDS))


QUERIES["ambiguous_rows"] = ambiguous_rows
ORACLES["ambiguous_rows"] = expected_sql(*cb.AMBIGUOUS_FIELDS, where=_AMBIGUOUS)


def prompt_column(spark, sf_dir):
    rows = replies.ambiguous_rows(coded(spark, sf_dir, *cb.AMBIGUOUS_FIELDS, *[column for _, column in cb.PROMPT_LINES]))
    return rows.select("html_id", replies.prompt().alias("prompt"))


QUERIES["prompt_column"] = prompt_column
ORACLES["prompt_column"] = f"""
  SELECT html_id, 'Classify ambiguous fields from this judgment excerpt.' || chr(10) || chr(10)
    || 'Topic: ' || {EXPECTED['topic']} || chr(10) || 'Issue: ' || {EXPECTED['issue']} || chr(10)
    || 'Parties: ' || coalesce({EXPECTED['parties']}, 'None') || chr(10)
    || 'Holdings: ' || left({_HOLDINGS}, 1600) || chr(10)
    || 'Text start: ' || left(full_text, 3000) || chr(10) AS prompt
  FROM ({written_sql()}) AS w WHERE {_AMBIGUOUS}"""


def parse_replies(spark, sf_dir):
    parsed = replies.parse_replies(reply_table(spark, sf_dir))
    return parsed.select(
        "html_id",
        "reply_area_detailed",
        "reply_app_class",
        "reply_resp_class",
        "reply_outcome",
        "reply_confidence",
        "reply_evidence",
        "reply_error",
    )


QUERIES["parse_replies"] = parse_replies
ORACLES["parse_replies"] = f"""
  SELECT CAST(k AS VARCHAR) AS html_id, {_R_AREA} AS reply_area_detailed, {_R_APP} AS reply_app_class,
    {_R_RESP} AS reply_resp_class, {_R_OUTCOME} AS reply_outcome, CAST({_R_CONFIDENCE} AS DOUBLE) AS reply_confidence,
    CASE WHEN k % 9 = 0 THEN 'short evidence' END AS reply_evidence, {_REPLY_ERROR} AS reply_error
  FROM (SELECT o_orderkey AS k FROM orders) AS o"""


def merge_replies(spark, sf_dir):
    fields = dict.fromkeys((*cb.AMBIGUOUS_FIELDS, *cb.REPLY_FIELDS))
    annotations = coded(spark, sf_dir, "raw_html_path", *fields, "outcome_binary", "confidence", "evidence", "warnings")
    merged = replies.merge_replies(annotations, reply_table(spark, sf_dir))
    return merged.select(
        "html_id",
        *cb.AMBIGUOUS_FIELDS,
        "outcome_binary",
        F.element_at("confidence", "outcome").alias("outcome_confidence"),
        F.element_at("confidence", "area_detailed").alias("area_confidence"),
        F.element_at("evidence", "app_class").alias("app_evidence"),
        F.array_join("warnings", ";").alias("warnings"),
    )


QUERIES["merge_replies"] = merge_replies
ORACLES["merge_replies"] = f"""
  SELECT html_id, coalesce({EXPECTED['area_detailed']}, {_R_AREA}) AS area_detailed,
    coalesce({EXPECTED['app_class']}, {_R_APP}) AS app_class,
    coalesce({EXPECTED['resp_class']}, {_R_RESP}) AS resp_class,
    coalesce({EXPECTED['outcome']}, {_R_OUTCOME}) AS outcome,
    coalesce({EXPECTED['outcome_binary']}, CASE WHEN oc = 5 AND k % 9 = 0 THEN TRUE WHEN oc = 5 AND k % 9 = 4 THEN FALSE END) AS outcome_binary,
    CAST(CASE WHEN oc = 5 AND k % 9 = 0 THEN 0.5 WHEN oc = 5 AND k % 9 = 4 THEN 1.0 END AS DOUBLE) AS outcome_confidence,
    CAST(CASE WHEN ar = 24 AND k % 9 = 0 THEN 0.5 END AS DOUBLE) AS area_confidence,
    CASE WHEN NOT has_parties AND k % 9 = 0 THEN 'short evidence' END AS app_evidence,
    concat_ws(';', nullif({EXPECTED['warnings']}, ''),
      CASE WHEN {_AMBIGUOUS} THEN 'llm_failed:' || {_REPLY_ERROR} END) AS warnings
  FROM ({written_sql()}) AS w"""
