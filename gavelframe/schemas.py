"""Explicit schemas of every record kind."""

from __future__ import annotations

from pyspark.sql import types as T

from gavelframe.functions import codebook as cb


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


_S, _I, _B = T.StringType(), T.IntegerType(), T.BooleanType()
_STRINGS = T.ArrayType(T.StringType())

DECISION = _struct(
    docid=_S,
    title=_S,
    url=_S,
    decision_date=T.DateType(),
    search_page_path=_S,
    source=_S,
    language=_S,
    court=_S,
)

REGISTRY = _struct(
    docid=_S,
    title=_S,
    url=_S,
    status=_S,
    http_status=_I,
    raw_html_path=_S,
    content_hash=_S,
    decision_date=_S,
    search_page_path=_S,
    scraped_at=_S,
    error_message=_S,
    source=_S,
    language=_S,
    court=_S,
    batch_seq=T.LongType(),
)

EXTRACTED = _struct(
    raw_html_path=_S,
    html_id=_S,
    extraction_version=_S,
    selector=_S,
    paragraph_selector=_S,
    paragraphs=_STRINGS,
    text=_S,
    paragraph_count=_I,
    char_count=_I,
    extracted_at=_S,
)

_INTEGERS = {"year", "n_judges", "length", "proc_duration", "n_cited_bger", "n_cited_bge"}
_BOOLEANS = {"merged_cases", "app_represented", "resp_represented", "outcome_binary"}


def _codebook_type(column: str) -> T.DataType:
    return _I if column in _INTEGERS else _B if column in _BOOLEANS else _S


CODEBOOK = _struct(**{c: _codebook_type(c) for c in cb.CODEBOOK_COLUMNS})

ANNOTATION = T.StructType(
    CODEBOOK.fields
    + _struct(
        html_id=_S,
        raw_html_path=_S,
        annotation_version=_S,
        model_name=_S,
        evidence=T.MapType(_S, _S),
        confidence=T.MapType(_S, T.DoubleType()),
        warnings=_STRINGS,
        judge_names=_STRINGS,
    ).fields
)

AGGREGATE = T.StructType(CODEBOOK.fields + _struct(**{c: _S for c in cb.AUDIT_COLUMNS}).fields)

QUARANTINE = _struct(html_id=_S, raw_html_path=_S, error_message=_S)

# Attempts at pages: what was read, when it was last changed, and what became of it.
LEDGER = _struct(raw_html_path=_S, length=T.LongType(), modificationTime=T.TimestampType(), error_message=_S, attempted_at=T.TimestampType())
