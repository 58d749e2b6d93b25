"""The codebook: 31 columns per judgment, from its paragraphs and registry row.

Everything is a narrow projection. Expressions that several columns need
(folded paragraphs, section positions, issue text, holdings) get a layer of
their own, so the optimiser keeps them as columns instead of repeating them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelframe import schemas
from gavelframe.functions import codebook as cb
from gavelframe.functions import dates
from gavelframe.functions import text as tx
from gavelframe.operators import registry as rg
from gavelframe.session import compile_stages, settle, spread_key
from gavelframe.sources import paths

_CASE = tx.at_word("1-9", cb.CASE_PATTERN)
_REPORT = tx.at_word("ABD", cb.REPORT_CITATION_PATTERN)

REGISTRY_INPUTS = ("docid", "url", "decision_date", "language")
INPUTS = ("html_id", "raw_html_path", "paragraphs", "text")
CONTEXT = ("parties", "holdings", "text_start")


# --- registry enrichment ---------------------------------------------------


def enrich(extracted: DataFrame, log: DataFrame, root: str | None = None) -> DataFrame:
    """Judgments (extracted, or coded already) with the registry columns of their page, as ``reg_*``.

    The registry side has one row per path after its aggregate, so a page can
    not multiply. Judgments without a path cannot match; their keys are spread
    instead of meeting in one task.
    """
    newest = rg.registry_by_path(log, root=root).select(
        paths.path_key(F.col("raw_html_path"), root).alias("_path"), *[F.col(c).alias(f"reg_{c}") for c in REGISTRY_INPUTS]
    )
    path = F.col("raw_html_path")
    keyed = extracted.withColumn("_key", spread_key(paths.path_key(path, root), path != "", F.col("html_id")))
    return keyed.join(newest, F.col("_key") == F.col("_path"), "left").drop("_key", "_path")


def without_registry(extracted: DataFrame) -> DataFrame:
    return extracted.withColumns({f"reg_{c}": F.lit(None).cast("string") for c in REGISTRY_INPUTS})


# --- single columns --------------------------------------------------------


def docref_from_docid(docid: Column) -> Column:
    number = F.replace(tx.capture(docid, tx.UNICODE + cb.DOCID_PATTERN, 1), F.lit("."), F.lit("_"))
    return F.concat(number, F.lit("/"), tx.capture(docid, tx.UNICODE + cb.DOCID_PATTERN, 2))


def page_docref(paragraphs: Column) -> Column:
    on_page = tx.first_match(tx.head(paragraphs, cb.HEAD_DOCREF), _CASE)
    return F.replace(on_page, F.lit("."), F.lit("_"))


def page_date(paragraphs: Column, folded: Column) -> Column:
    """Date beside a decision heading among the first paragraphs."""
    found = F.zip_with(
        tx.head(paragraphs, cb.HEAD_DATE),
        tx.head(folded, cb.HEAD_DATE),
        lambda p, f: F.when(tx.contains_any(f, cb.DECISION_DATE_MARKERS), dates.parse_date_text(p)),
    )
    return dates.iso(F.get(F.filter(found, lambda d: d.isNotNull()), 0))


def opening(paragraphs: Column) -> Column:
    """Folded head of the page, line breaks kept."""
    return tx.bound(F.array_join(tx.head(paragraphs, cb.HEAD_LANGUAGE), "\n"), tx.casefold)


def folded_start(text: Column, paragraphs: Column, folded: Column, n: int) -> Column:
    """Folded first ``n`` characters of the text.

    A text that is no longer, and no other than its paragraphs, line by line,
    is put together from what is folded already. Folding drops outer blanks and
    looks at no letter beyond a blank, so the parts give the same as the whole.
    """
    known = (F.length(text) <= n) & (F.trim(text) == F.trim(F.array_join(paragraphs, "\n")))
    # A line break is white space like any other; with blanks in their place most texts are even already.
    cut = F.replace(tx.prefix(text, n), F.lit("\n"), F.lit(" "))
    return F.when(known, F.array_join(F.array_remove(folded, ""), " ")).otherwise(tx.bound(cut, tx.fold))


def page_language(folded_opening: Column) -> Column:
    return tx.first_hit(folded_opening, cb.LANGUAGE_MARKERS)


def proc_type(ref: Column) -> Column:
    return tx.lookup(F.regexp_extract(ref, tx.UNICODE + r"^\d+([A-Z])", 1), cb.PROCEDURE_TYPES)


def division(ref: Column, date: Column) -> Column:
    """Division by first digit, under the name that it has on the date; the oldest name without a date."""
    name = F.lit(None).cast("string")
    for digit, names in cb.DIVISIONS.items():
        then = F.lit(names[-1][1])
        for since, label in reversed(names[:-1]):
            then = F.when(date >= since, label).otherwise(then)
        name = F.when(tx.prefix(ref, 1) == digit, then).otherwise(name)
    return name


def division_type(name: Column) -> Column:
    return tx.first_hit(name, cb.DIVISION_TYPES)


def _composition(paragraphs: Column, keys: Column, position: Column) -> Column:
    """Paragraphs of the composition section, up to the next heading."""
    starts = tuple(f"{stop} " for stop in cb.COMPOSITION_STOPS)
    stops = F.transform(
        tx.after(keys, position, cb.COMPOSITION_SPAN),
        lambda k: k.isin(*cb.COMPOSITION_STOPS) | tx.starts_with_any(k, starts),
    )
    return tx.take_until(tx.after(paragraphs, position, cb.COMPOSITION_SPAN), stops)


def judge_names(composition: Column) -> Column:
    """Names left after clerks, titles and functions are removed; empty array if none."""
    text = tx.join_spaced(composition)
    for pattern in (cb.CLERK_TAIL_PATTERN, cb.JUDGE_TITLE_PATTERN, cb.PRESIDENT_PATTERN, cb.SUBSTITUTE_PATTERN):
        text = F.regexp_replace(text, tx.UNICODE_NOCASE_UNIXLINES + pattern, "")
    for word in cb.NAME_CONJUNCTIONS:
        text = F.replace(text, F.lit(word), F.lit(","))
    names = F.transform(F.split(text, ","), lambda n: tx.squeeze(F.btrim(n, F.lit(" .:;"))))
    names = F.transform(
        F.filter(names, lambda n: n != ""),
        lambda n: F.regexp_replace(n, tx.UNICODE_NOCASE + cb.NAME_ARTICLE_PATTERN, ""),
    )
    return F.coalesce(
        F.filter(names, lambda n: ~n.rlike(tx.UNICODE_NOCASE + cb.CLERK_NAME_PATTERN)),
        F.array().cast("array<string>"),
    )


def _subject_lines(paragraphs: Column, folded: Column, position: Column) -> Column:
    """Lines of the subject section, up to the facts or an enumerator."""
    stops = F.zip_with(
        tx.after(paragraphs, position, cb.SUBJECT_SPAN),
        tx.after(folded, position, cb.SUBJECT_SPAN),
        lambda p, f: tx.starts_with_any(f, cb.SUBJECT_STOPS)
        | tx.strip_blanks(p).rlike(rf"\A(?:{cb.ENUMERATOR_PATTERN})\z"),
    )
    return tx.take_until(tx.after(paragraphs, position, cb.SUBJECT_SPAN), stops)


def issue(lines: Column) -> Column:
    return tx.null_if_empty(tx.bound(tx.join_spaced(lines), tx.squeeze))


def topic(lines: Column) -> Column:
    return tx.null_if_empty(tx.squeeze(F.rtrim(F.get(lines, 0), F.lit(",.;"))))


def source_date(issue_text: Column) -> Column:
    """Latest date of the issue, before any procedural wording."""
    context = F.get(tx.split_once(issue_text, cb.PROCEDURAL_CUT_PATTERN), 0)
    return dates.iso(dates.latest_date(context))


def source_canton(folded_issue: Column) -> Column:
    rules = [(cb.FEDERAL_SOURCE, cb.FEDERAL_SOURCE_TERMS), *cb.CANTON_TERMS.items()]
    return tx.first_hit(folded_issue, rules)


def head_cases(paragraphs: Column) -> Column:
    """Dockets named in the head of the page, in one spelling."""
    found = tx.capture_all(tx.join_spaced(tx.head(paragraphs, cb.HEAD_MERGED)), _CASE, 1)
    return F.transform(found, lambda f: F.replace(f, F.lit("."), F.lit("_")))


def merged_cases(in_head: Column, ref: Column) -> Column:
    """Does the head of the page name a docket other than its own?"""
    return F.size(F.array_except(in_head, F.array(F.coalesce(ref, F.lit(""))))) > 0


def party_block(paragraphs: Column, keys: Column, position: Column) -> Column:
    """Text between the party heading and the subject heading that follows it."""
    following = F.slice(keys, position + 1, F.greatest(F.size(keys) - position, F.lit(0)))
    end = tx.first_position(following, cb.SUBJECT_MARKERS)
    length = F.coalesce(end - 1, F.lit(cb.PARTY_SPAN))
    return tx.bound(tx.join_spaced(F.slice(paragraphs, position + 1, length)), tx.squeeze)


def party_class(party: Column) -> Column:
    """state, legal or natural for a folded party text; NULL for none."""
    return (
        F.when(party.isNull() | (party == ""), F.lit(None).cast("string"))
        .when(tx.contains_any(party, cb.STATE_TERMS), "state")
        .when(party.rlike(tx.UNICODE + cb.COMPANY_SUFFIX_PATTERN), "legal")
        .when(tx.contains_any(party, cb.LEGAL_TERMS), "legal")
        .otherwise("natural")
    )


def represented(party: Column) -> Column:
    """Is a lawyer named in a folded party text? NULL for no party."""
    padded = F.concat(F.lit(" "), party, F.lit(" "))
    return F.when(party != "", tx.contains_any(padded, cb.LAWYER_TERMS))


def holdings(paragraphs: Column, folded: Column) -> Column:
    """From the first holding formula to the end, else the last paragraphs."""
    marked = F.transform(folded, lambda f: tx.contains_any(f, cb.HOLDING_MARKERS))
    size = F.size(paragraphs)

    def section(start: Column) -> Column:
        first = F.when(start > 0, start).otherwise(F.greatest(F.lit(1), size - (cb.HOLDINGS_TAIL - 1)))
        return tx.join_spaced(F.slice(paragraphs, first, F.greatest(size, F.lit(1))))

    return tx.bound(tx.bound(F.array_position(marked, F.lit(True)).cast("int"), section), tx.squeeze)


def outcome(folded_holdings: Column) -> Column:
    return tx.first_hit(folded_holdings, cb.OUTCOME_TERMS)


def outcome_flag(label: Column) -> Column:
    return F.when(label.isin(*cb.OUTCOMES_TRUE), True).when(label.isin(*cb.OUTCOMES_FALSE), False)


def cases_in_text(text: Column) -> Column:
    """Dockets in text order, repeats kept."""
    return tx.capture_all(text, _CASE, 1)


def dotted_in_text(text: Column) -> Column:
    """Every dotted docket that occurs as a plain substring, also inside longer words."""
    return F.array_distinct(tx.capture_all(text, r"(?=[1-9][A-Z]\.)(?=([1-9][A-Z]\.\d+/\d{4}))", 1))


def case_citations(found: Column, dotted: Column, ref: Column) -> Column:
    """Dockets of the text; the own one in front unless the text has it in either spelling."""
    absent = (ref != "") & ~F.array_contains(found, ref) & ~F.array_contains(dotted, F.replace(ref, F.lit("_"), F.lit(".")))
    return F.when(absent, F.concat(F.array(ref), found)).otherwise(found)


def report_citations(text: Column) -> Column:
    """Citations of the official reports in text order, white space still raw."""
    return tx.capture_all(text, _REPORT, 1)


def leading_case(paragraphs: Column) -> Column:
    head = tx.join_spaced(tx.head(paragraphs, cb.HEAD_LEADING))
    return tx.capture(head, tx.at_word("B", cb.LEADING_CASE_PATTERN), 1)


def area_detailed(haystack: Column) -> Column:
    return tx.first_hit(haystack, cb.AREA_TERMS.items())


def area_intermediate(detailed: Column) -> Column:
    return tx.lookup(detailed, {label: pair[0] for label, pair in cb.AREA_ROLLUP.items()})


def area_general(detailed: Column) -> Column:
    return tx.lookup(detailed, {label: pair[1] for label, pair in cb.AREA_ROLLUP.items()})


def evidence(entries: dict[str, Column]) -> Column:
    """Map of the non-empty entries."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in entries.items()])
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"] != ""))


def missing_warnings(fields: tuple[str, ...] = cb.WARNED_FIELDS) -> Column:
    notes = F.array(*[F.when(F.col(f).isNull(), F.lit(f"missing_{f}")) for f in fields])
    return F.filter(notes, lambda n: n.isNotNull())


# --- the whole record ------------------------------------------------------


def with_sections(judgments: DataFrame) -> DataFrame:
    """Layers shared by the derivations: folded paragraphs, heading keys, sections."""
    empty = F.array().cast("array<string>")
    base = judgments.withColumn("paragraphs", F.coalesce("paragraphs", empty))
    base = base.withColumn("text", F.coalesce(tx.null_if_empty(F.col("text")), F.array_join("paragraphs", "\n")))
    base = base.withColumn("_folded", F.transform("paragraphs", tx.fold))
    base = base.withColumn("_keys", F.transform("_folded", tx.marker_key))
    keys, folded, paragraphs = F.col("_keys"), F.col("_folded"), F.col("paragraphs")
    base = base.withColumns(
        {
            "_at_composition": tx.first_position(keys, cb.COMPOSITION_MARKERS),
            "_at_subject": tx.first_position(keys, cb.SUBJECT_MARKERS),
            "_at_parties": tx.first_position(keys, cb.PARTY_MARKERS),
        }
    )
    base = base.withColumns(
        {
            "_composition": _composition(paragraphs, keys, F.col("_at_composition")),
            "_subject": _subject_lines(paragraphs, folded, F.col("_at_subject")),
            "_opening": opening(paragraphs),
            "_parties": party_block(paragraphs, keys, F.col("_at_parties")),
            "_holdings": holdings(paragraphs, folded),
            "_page_date": page_date(paragraphs, folded),
            "_page_docref": page_docref(paragraphs),
        }
    )
    base = base.withColumns(
        {
            "issue": issue(F.col("_subject")),
            "topic": topic(F.col("_subject")),
            "_sides": tx.split_once(F.col("_parties"), cb.VERSUS_PATTERN),
            "judge_names": judge_names(F.col("_composition")),
            "_folded_holdings": tx.casefold(F.col("_holdings")),
        }
    )
    both = F.size("_sides") == 2
    base = base.withColumns(
        {
            "_appellant": F.when(both, tx.bound(F.get("_sides", F.lit(0)), tx.fold)),
            "_respondent": F.when(both, tx.bound(F.get("_sides", F.lit(1)), tx.fold)),
            "_folded_issue": tx.fold(F.col("issue")),
        }
    )
    start = folded_start(F.col("text"), paragraphs, folded, cb.AREA_CHARS)
    return base.withColumn(
        "_haystack", F.concat_ws(" ", tx.fold(F.col("topic")), F.col("_folded_issue"), tx.null_if_empty(start))
    )


def code_page(judgments: DataFrame) -> DataFrame:
    """Everything that the page alone decides, without its full text.

    Registry columns, if already there, are carried along. Rows are small from
    here on: the text itself never has to move for a join. The rules make long
    stages, which the session is told to compile.
    """
    compile_stages(judgments.sparkSession)
    rows = with_sections(judgments)
    text = F.col("text")
    rows = rows.withColumns({"_cases": cases_in_text(text), "_reports": report_citations(text)})
    carried = [f"reg_{c}" for c in REGISTRY_INPUTS if f"reg_{c}" in judgments.columns]
    return rows.select(
        "html_id",
        "raw_html_path",
        *carried,
        "_page_docref",
        "_page_date",
        page_language(F.col("_opening")).alias("_page_language"),
        head_cases(F.col("paragraphs")).alias("_head_cases"),
        "judge_names",
        F.length("text").alias("length"),
        area_detailed(F.col("_haystack")).alias("area_detailed"),
        "topic",
        "issue",
        source_date(F.col("issue")).alias("source_date"),
        source_canton(F.col("_folded_issue")).alias("source_canton"),
        party_class(F.col("_appellant")).alias("app_class"),
        represented(F.col("_appellant")).alias("app_represented"),
        party_class(F.col("_respondent")).alias("resp_class"),
        represented(F.col("_respondent")).alias("resp_represented"),
        outcome(F.col("_folded_holdings")).alias("outcome"),
        "_cases",
        dotted_in_text(text).alias("_dotted"),
        tx.null_if_empty(tx.squeeze(F.array_join("_reports", ";"))).alias("cited_bge"),
        F.size("_reports").alias("n_cited_bge"),
        leading_case(F.col("paragraphs")).alias("leading_case"),
        F.col("_parties").alias("parties"),
        tx.prefix(F.col("_holdings"), cb.CONTEXT_HOLDINGS_CHARS).alias("holdings"),
        tx.prefix(text, cb.CONTEXT_TEXT_CHARS).alias("text_start"),
    )


def finish(pages: DataFrame, model_name: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Annotation records from coded pages and their ``reg_*`` columns; settled."""
    rows = pages.withColumns(
        {
            "docref": F.coalesce(docref_from_docid(F.col("reg_docid")), F.col("_page_docref")),
            "date": F.coalesce(F.col("_page_date"), tx.null_if_empty(F.col("reg_decision_date"))),
            "n_judges": _size_or_null(F.col("judge_names")),
        }
    )
    ref, date = F.col("docref"), F.col("date")
    rows = rows.withColumns(
        {
            "url": F.col("reg_url"),
            "year": dates.year_of(date),
            "proc_type": proc_type(ref),
            "merged_cases": merged_cases(F.col("_head_cases"), ref),
            "division": division(ref, date),
            "language": F.coalesce("_page_language", "reg_language"),
            "area_general": area_general(F.col("area_detailed")),
            "area_intermediate": area_intermediate(F.col("area_detailed")),
            "proc_duration": dates.days_between(date, F.col("source_date")),
            "outcome_binary": outcome_flag(F.col("outcome")),
            "_cited": case_citations(F.col("_cases"), F.col("_dotted"), ref),
            "doi_version": F.lit(cb.DOI_VERSION),
            "html_id": F.coalesce("html_id", F.lit("")),
            "raw_html_path": F.coalesce("raw_html_path", F.lit("")),
            "annotation_version": F.lit(cb.ANNOTATION_VERSION),
            "model_name": F.lit(model_name).cast("string"),
            "confidence": F.create_map().cast("map<string,double>"),
            "warnings": missing_warnings(),
        }
    )
    proof = {
        "issue": F.col("issue"),
        "parties": F.col("parties"),
        "outcome": F.when(F.col("outcome").isNotNull(), tx.prefix(F.col("holdings"), cb.EVIDENCE_CHARS)),
    }
    no_year = date.isNotNull() & F.col("year").isNull()
    rows = rows.withColumns(
        {
            "division_type": division_type(F.col("division")),
            "cited_bger": tx.null_if_empty(F.array_join("_cited", ";")),
            "n_cited_bger": F.size("_cited"),
            "evidence": evidence(proof),
            "error_message": F.when(no_year, F.concat(F.lit("no year in date: "), date)),
        }
    )
    return settle(rows.select(*(keep or (*schemas.ANNOTATION.fieldNames(), *CONTEXT, "error_message"))))


def annotate(
    judgments: DataFrame, model_name: str | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """Full annotation record of each judgment, or only the columns in ``keep``.

    Input: ``html_id, raw_html_path, paragraphs, text`` and ``reg_*`` columns.
    The output also has ``parties``, ``holdings`` and ``text_start`` for the
    prompt, and ``error_message`` for rows whose date has no year. The result
    is settled: filters on it do not repeat the rules. Name the columns in
    ``keep`` when few are needed, so the others are not computed.
    """
    return finish(code_page(judgments), model_name, keep)


def annotate_with_log(
    extracted: DataFrame,
    log: DataFrame,
    model_name: str | None = None,
    keep: Sequence[str] | None = None,
    root: str | None = None,
) -> DataFrame:
    """Annotation records of extracted judgments, with the registry log joined in.

    Pages are coded first, so the join moves the coded columns, not the texts.
    """
    return finish(enrich(code_page(extracted), log, root), model_name, keep)


def _size_or_null(arr: Column) -> Column:
    return F.nullif(F.size(arr), F.lit(0))


def stamp(annotations: DataFrame) -> DataFrame:
    """Record the time of the run in the evidence map."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return annotations.withColumn("evidence", F.map_concat("evidence", F.create_map(F.lit("annotated_at"), now)))
