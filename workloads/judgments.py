"""Judgments written from the orders table.

Every order becomes one judgment. Its key and columns decide a set of codes
(language, docket, outcome, canton, parties, ...); templates in three
languages write the text that carries them. The SQL below is plain enough for
both engines: Spark uses it as input of the coding rules, DuckDB to state the
expected label of each code, which never looks at the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelframe.functions import codebook as cb
from gavelframe.session import compile_stages, use_all_cores

NAMES = "Aebischer,Zanetti,Kübler,Rochat,Bovet,Favrod,Soldati,Quadri,Bühler,Steiner"
MONTHS = (
    "Januar,Februar,März,April,Mai,Juni,Juli,August,September,Oktober,November,Dezember",
    "janvier,février,mars,avril,mai,juin,juillet,août,septembre,octobre,novembre,décembre",
    "gennaio,febbraio,marzo,aprile,maggio,giugno,luglio,agosto,settembre,ottobre,novembre,dicembre",
)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def by_code(column: str, values: list[str | None], quoted: bool = True) -> str:
    """CASE over 0, 1, 2, ... of a code column."""
    branches = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else q(v) if quoted else v}" for i, v in enumerate(values)
    )
    return f"(CASE {column} {branches} END)"


def per_language(de: str, fr: str, it: str) -> str:
    """CASE over the language code; the arguments are SQL expressions."""
    return f"(CASE lang WHEN 0 THEN {de} WHEN 1 THEN {fr} ELSE {it} END)"


def div(n: int) -> str:
    return f"CAST(FLOOR(k / {n}) AS BIGINT)"


AREA_LABELS = list(cb.AREA_TERMS)
CANTONS = list(cb.CANTON_TERMS)
OUTCOMES = [label for label, _ in cb.OUTCOME_TERMS]
PARTY_KINDS = ["natural", "legal", "state"]

_CODES = f"""
  SELECT k, o_orderdate, o_orderpriority, o_orderstatus,
    k % 3 AS lang,
    {div(3)} % 8 AS digit, {div(24)} % 8 AS letter, k % 900 + 1 AS num,
    {div(5)} % 6 AS oc, {div(7)} % 28 AS cn,
    {div(11)} % 4 AS nj, {div(13)} % 3 AS ap, {div(17)} % 3 AS rp,
    {div(19)} % 2 AS al, {div(23)} % 2 AS rl,
    {div(29)} % 6 <> 0 AS has_parties,
    {div(37)} % 4 AS nc, {div(41)} % 25 AS ar,
    {div(43)} % 3 = 0 AS has_tail, {div(47)} % 4 = 0 AS has_lead,
    {div(53)} % 3 <> 0 AS has_marker, 30 + {div(59)} % 400 AS days, {div(61)} % 3 AS df,
    {div(71)} % 2 = 1 AS docid_dot, {div(73)} % 2 = 1 AS head_dot, {div(79)} % 2 = 1 AS loud,
    o_orderpriority <> '5-LOW' AS has_registry,
    NOT (o_orderpriority = '1-URGENT' OR (o_orderpriority = '5-LOW' AND {div(67)} % 4 = 0)) AS has_head,
    o_orderstatus <> 'P' AS has_date,
    {div(31)} % 5 = 0 AS wants_merge,
    CAST(CAST(o_orderdate AS DATE) + INTERVAL '24' YEAR AS DATE) AS decided
  FROM (SELECT o_orderkey AS k, o_orderdate, o_orderpriority, o_orderstatus FROM {{orders}}) AS o
"""

_DOCKET = (
    f"{by_code('digit', list('12456789'))} || substr('ABCDEFGH', CAST(letter + 1 AS INTEGER), 1)"
)

_FACTS = f"""
  SELECT *, has_head AND wants_merge AS is_merged,
    decided - CAST(days AS INTEGER) AS source_day,
    {_DOCKET} || '_' || CAST(num AS VARCHAR(20)) || '/' || CAST(year(decided) AS VARCHAR(20)) AS own_ref,
    {_DOCKET} || '_' || CAST(num + 1 AS VARCHAR(20)) || '/' || CAST(year(decided) AS VARCHAR(20)) AS other_ref,
    lpad(CAST(day(decided) AS VARCHAR(2)), 2, '0') AS dd,
    lpad(CAST(month(decided) AS VARCHAR(2)), 2, '0') AS mm,
    CAST(year(decided) AS VARCHAR(4)) AS yyyy
  FROM ({_CODES}) AS codes
"""


def _date_text(day: str) -> str:
    """Written-out date in the language of the judgment."""
    number = f"CAST(day({day}) AS VARCHAR(2))"
    year = f"CAST(year({day}) AS VARCHAR(4))"
    month = [f"split_part({q(names)}, ',', CAST(month({day}) AS INTEGER))" for names in MONTHS]
    return per_language(
        f"{number} || '. ' || {month[0]} || ' ' || {year}",
        f"{number} || CASE WHEN day({day}) = 1 THEN 'er ' ELSE ' ' END || {month[1]} || ' ' || {year}",
        f"{number} || ' ' || {month[2]} || ' ' || {year}",
    )


def _date_number(day: str) -> str:
    return (
        f"lpad(CAST(day({day}) AS VARCHAR(2)), 2, '0') || '.' || lpad(CAST(month({day}) AS VARCHAR(2)), 2, '0')"
        f" || '.' || CAST(year({day}) AS VARCHAR(4))"
    )


def judge(i: int) -> str:
    return f"split_part({q(NAMES)}, ',', CAST((k + {3 * i}) % 10 + 1 AS INTEGER))"


def _term_of_area() -> str:
    """One of the terms of the area, picked by the key."""
    branches = []
    for code, terms in enumerate(cb.AREA_TERMS.values()):
        listed = q("|".join(terms))
        branches.append(f"WHEN {code} THEN split_part({listed}, '|', CAST(k % {len(terms)} + 1 AS INTEGER))")
    term = f"(CASE ar {' '.join(branches)} ELSE 'Verschiedenes' END)"
    return f"(CASE WHEN loud THEN upper({term}) ELSE {term} END)"


TOPIC = _term_of_area()
_CANTON_NAME = by_code("cn", [terms[0] for terms in cb.CANTON_TERMS.values()])
_COURT = (
    "(CASE WHEN cn = 26 THEN "
    + per_language(q("Bundesverwaltungsgerichts"), q("Tribunal administratif fédéral"), q("Tribunale amministrativo federale"))
    + " WHEN cn = 27 THEN "
    + per_language(q("Obergerichts"), q("Tribunal supérieur"), q("Tribunale d'appello"))
    + f" ELSE {per_language(q('Verwaltungsgerichts des Kantons '), q('Tribunal cantonal du canton de '), q('Tribunale cantonale del Cantone '))}"
    + f" || {_CANTON_NAME} END)"
)
_WHEN = (
    f"(CASE df WHEN 0 THEN {_date_text('source_day')} WHEN 1 THEN {_date_number('source_day')} ELSE '' END)"
)
_ON = per_language("' vom '", "' du '", "' del '")
_TAIL_DAY = "(decided + 5)"
_TAIL = (
    "(CASE WHEN has_tail THEN "
    + per_language(
        f"' Nach Einsicht in die Eingabe vom ' || {_date_text(_TAIL_DAY)}",
        f"' Vu :la requête du ' || {_date_text(_TAIL_DAY)}",
        f"' Visto il ricorso del ' || {_date_text(_TAIL_DAY)}",
    )
    + " ELSE '' END)"
)
_SUBJECT = (
    per_language(
        q("Beschwerde gegen den Entscheid des "), q("recours contre la décision du "), q("ricorso contro la decisione del ")
    )
    + f" || {_COURT} || CASE WHEN df < 2 THEN {_ON} || {_WHEN} ELSE '' END || '.' || {_TAIL}"
)
_APPELLANT = per_language(
    by_code("ap", ["A.________, Beschwerdeführer,", "X.________ AG, Beschwerdeführerin,", "Gemeinde Musterwil, Beschwerdeführerin,"]),
    by_code("ap", ["A.________, recourant,", "X.________ SA, recourante,", "Office fédéral des routes, recourant,"]),
    by_code("ap", ["A.________, ricorrente,", "X.________ SA, ricorrente,", "Consiglio di Stato, ricorrente,"]),
)
_RESPONDENT = per_language(
    by_code("rp", ["B.________, Beschwerdegegner.", "Y.________ GmbH, Beschwerdegegnerin.", "Kanton Aargau, Beschwerdegegner."]),
    by_code("rp", ["B.________, intimé.", "Y.________ Sàrl, intimée.", "Ministère public du canton, intimé."]),
    by_code("rp", ["B.________, opponente.", "Y.________ SA, opponente.", "Consiglio di Stato del Cantone, opponente."]),
)
_LAWYER = per_language(
    q("vertreten durch Rechtsanwalt Meier,"), q("représenté par Me Favre, avocat,"), q("patrocinato dall'avvocato Bianchi,")
)
_LINES = {
    "p01": per_language(q("Bundesgericht"), q("Tribunal fédéral"), q("Tribunale federale")),
    "p02": (
        "CASE WHEN has_head THEN CASE WHEN head_dot THEN replace(own_ref, '_', '.') ELSE own_ref END"
        " || CASE WHEN is_merged THEN ', ' || other_ref ELSE '' END END"
    ),
    "p03": "CASE WHEN has_lead THEN 'BGE ' || CAST(100 + k % 40 AS VARCHAR(9)) || ' II ' || CAST(1 + k % 300 AS VARCHAR(9)) END",
    "p04": (
        f"CASE WHEN has_date THEN {per_language(q('Urteil vom '), q('Arrêt du '), q('Sentenza del '))} || {_date_text('decided')} END"
    ),
    "p05": per_language(q("II. Abteilung"), q("IIe Cour de droit"), q("II Corte di diritto")),
    "p06": f"CASE WHEN nj > 0 THEN {per_language(q('Besetzung'), q('Composition'), q('Composizione'))} END",
    "p07": "CASE nj WHEN 1 THEN "
    + per_language(
        f"'Bundesrichter ' || {judge(0)} || ', präsidierendes Mitglied,'",
        f"'M. le Juge ' || {judge(0)} || ', président de la Cour.'",
        f"'Giudice federale ' || {judge(0)} || ', presidente,'",
    )
    + " WHEN 2 THEN "
    + per_language(
        f"'Bundesrichter ' || {judge(0)} || ', Präsident,'",
        f"'MM. et Mme les Juges fédéraux ' || {judge(0)} || ', Président, ' || {judge(1)} || ' et ' || {judge(2)} || '.'",
        f"'Giudici federali ' || {judge(0)} || ', presidente,'",
    )
    + " WHEN 3 THEN "
    + per_language(
        f"'Bundesrichterin ' || {judge(0)} || ', Präsidentin,'",
        f"'MM. les Juges ' || {judge(0)} || ', Président, ' || {judge(1)} || ', ' || {judge(2)} || ', ' || {judge(3)} || ' et ' || {judge(4)} || '.'",
        f"'Giudici federali ' || {judge(0)} || ', presidente,'",
    )
    + " END",
    "p08": "CASE nj WHEN 2 THEN "
    + per_language(
        f"'Bundesrichterin ' || {judge(1)} || ' und Bundesrichter ' || {judge(2)} || ','",
        "NULL",
        f"{judge(1)} || ' e ' || {judge(2)} || ','",
    )
    + " WHEN 3 THEN "
    + per_language(
        f"'Bundesrichter ' || {judge(1)} || ', ' || {judge(2)} || ', ' || {judge(3)} || ', Bundesrichterin ' || {judge(4)} || ','",
        "NULL",
        f"{judge(1)} || ', ' || {judge(2)} || ', ' || {judge(3)} || ' e ' || {judge(4)} || ','",
    )
    + " END",
    "p09": f"CASE WHEN nj > 0 THEN {per_language(q('Gerichtsschreiberin Loosli.'), q('Greffière : Mme Junod.'), q('Cancelliera Ferrari.'))} END",
    "p10": f"CASE WHEN has_parties THEN {per_language(q('Parteien'), q('Parties'), q('Parti'))} END",
    "p11": f"CASE WHEN has_parties THEN {_APPELLANT} END",
    "p12": f"CASE WHEN has_parties AND al = 1 THEN {_LAWYER} END",
    "p13": f"CASE WHEN has_parties THEN {per_language(q('gegen'), q('contre'), q('contro'))} END",
    "p14": f"CASE WHEN has_parties THEN {_RESPONDENT} END",
    "p15": f"CASE WHEN has_parties AND rl = 1 THEN {_LAWYER} END",
    "p16": per_language(q("Gegenstand"), q("Objet"), q("Oggetto")),
    "p17": f"{TOPIC} || ','",
    "p18": _SUBJECT,
    "p19": per_language(q("Sachverhalt:"), q("Faits:"), q("Fatti:")),
    # Enough lines that the citations lie beyond the head that the rules look at.
    **{f"p20{x}": f"'Die Parteien streiten um Sache ' || CAST(k + {i} AS VARCHAR(20)) || '.'" for i, x in enumerate("abcdefghi")},
    "p21": "CASE nc WHEN 1 THEN 'Vgl. 6P.12/2005; BGE 129 II 44.' WHEN 2 THEN 'Vgl. 6P.12/2005, 7A.8/2006; BGE 129 II 44; ATF 138  III 7.'"
    " WHEN 3 THEN 'Vgl. 6P.12/2005, 7A.8/2006, 9C_71/2012; BGE 129 II 44; ATF 138  III 7, DTF 120 II 5.' END",
    "p22": f"CASE WHEN has_marker THEN {per_language(q('Demnach erkennt das Bundesgericht:'), q('Par ces motifs, le Tribunal fédéral prononce:'), q('Per questi motivi, il Tribunale federale pronuncia:'))} END",
    "p23": "'1.'",
    "p24": per_language(
        by_code(
            "oc",
            [
                "Die Beschwerde wird teilweise gutgeheissen.",
                "Auf die Beschwerde wird nicht eingetreten.",
                "Die Beschwerde wird gutgeheissen.",
                "Die Beschwerde wird abgewiesen.",
                "Das Verfahren wird als gegenstandslos abgeschrieben.",
                "Die Sache geht zurück.",
            ],
        ),
        by_code(
            "oc",
            [
                "Le recours est partiellement admis.",
                "Le recours est irrecevable.",
                "Le recours est admis.",
                "Le recours est rejeté.",
                "La cause est rayée du rôle.",
                "La cause est renvoyée.",
            ],
        ),
        by_code(
            "oc",
            [
                "Il ricorso è parzialmente accolto.",
                "Il ricorso è inammissibile.",
                "Il ricorso è accolto.",
                "Il ricorso è respinto.",
                "La causa è stralciata.",
                "La causa è rinviata.",
            ],
        ),
    ),
}
LINES = list(_LINES)

_WRITTEN = (
    "SELECT *, "
    + ", ".join(f"{expression} AS {name}" for name, expression in _LINES.items())
    + f" FROM ({_FACTS}) AS facts"
)

# One row per judgment: codes, lines p01..p24, and the registry values.
WRITTEN_SQL = f"""
  SELECT *, CAST(k AS VARCHAR(20)) AS html_id,
    'raw/' || lpad(CAST(k % 100 AS VARCHAR(2)), 2, '0') || '/' || CAST(k AS VARCHAR(20)) || '.html' AS raw_html_path,
    concat_ws(chr(10), {', '.join(LINES)}) AS full_text,
    CASE WHEN has_registry THEN 'aza://' || dd || '-' || mm || '-' || yyyy || '-'
      || replace(CASE WHEN docid_dot THEN replace(own_ref, '_', '.') ELSE own_ref END, '/', '-') END AS reg_docid,
    CASE WHEN has_registry THEN 'https://example.test/' || CAST(k AS VARCHAR(20)) END AS reg_url,
    CASE WHEN has_registry THEN yyyy || '-' || mm || '-' || dd END AS reg_decision_date,
    CASE WHEN has_registry THEN 'de' END AS reg_language
  FROM ({_WRITTEN}) AS written
"""


def _isodate(day: str) -> str:
    return (
        f"CAST(year({day}) AS VARCHAR) || '-' || lpad(CAST(month({day}) AS VARCHAR), 2, '0') || '-' || "
        f"lpad(CAST(day({day}) AS VARCHAR), 2, '0')"
    )


_REF = "(CASE WHEN has_registry OR has_head THEN own_ref END)"
_DATE = f"(CASE WHEN has_date OR has_registry THEN {_isodate('decided')} END)"
_LATE = "decided >= DATE '{}' AND (has_date OR has_registry)"
_SOCIAL = _LATE.format("2023-01-01")
_CRIMINAL = _LATE.format("2023-07-01")
_NAME_LISTS = [[], [0], [0, 1, 2], [0, 1, 2, 3, 4]]
_OWN_IN_TEXT = "CASE WHEN head_dot THEN replace(own_ref, '_', '.') ELSE own_ref END"
_LEAD = "(CASE WHEN has_lead THEN CAST(100 + k % 40 AS VARCHAR) || ' II ' || CAST(1 + k % 300 AS VARCHAR) END)"
_HOLDINGS = f"concat_ws(' ', p22, p23, p24)"

# Expected value of every codebook column, in DuckDB SQL over the codes.
EXPECTED = {
    "docref": _REF,
    "url": "reg_url",
    "date": _DATE,
    "year": f"CAST(CASE WHEN has_date OR has_registry THEN year(decided) END AS BIGINT)",
    "proc_type": f"CASE WHEN {_REF} IS NOT NULL THEN {by_code('letter', [*cb.PROCEDURE_TYPES.values(), None])} END",
    "merged_cases": "is_merged",
    "division": f"CASE WHEN {_REF} IS NOT NULL THEN CASE digit WHEN 0 THEN '1. Public' WHEN 1 THEN '2. Public' WHEN 2 THEN '1. Civil' "
    f"WHEN 3 THEN '2. Civil' WHEN 4 THEN CASE WHEN {_CRIMINAL} THEN '1. Criminal' ELSE 'Criminal' END "
    f"WHEN 5 THEN CASE WHEN {_CRIMINAL} THEN '2. Criminal' ELSE 'Criminal' END "
    f"WHEN 6 THEN CASE WHEN {_SOCIAL} THEN '4. Public' ELSE '1. Social' END "
    f"WHEN 7 THEN CASE WHEN {_SOCIAL} THEN '3. Public' ELSE '2. Social' END END END",
    "division_type": f"CASE WHEN {_REF} IS NOT NULL THEN CASE WHEN digit IN (2, 3) THEN 'Civil' WHEN digit IN (4, 5) THEN 'Criminal' ELSE 'Public' END END",
    "n_judges": "CAST(CASE nj WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 5 END AS BIGINT)",
    "language": "CASE lang WHEN 0 THEN 'de' WHEN 1 THEN 'fr' ELSE 'it' END",
    "length": "CAST(length(full_text) AS BIGINT)",
    "area_general": by_code("ar", [cb.AREA_ROLLUP[a][1] for a in AREA_LABELS] + [None]),
    "area_intermediate": by_code("ar", [cb.AREA_ROLLUP[a][0] for a in AREA_LABELS] + [None]),
    "area_detailed": by_code("ar", [*AREA_LABELS, None]),
    "topic": TOPIC,
    "issue": "p17 || ' ' || p18",
    "source_date": f"CASE WHEN df < 2 THEN {_isodate('source_day')} END",
    "source_canton": by_code("cn", [*CANTONS, "CH", None]),
    "proc_duration": "CAST(CASE WHEN df < 2 AND (has_date OR has_registry) THEN days END AS BIGINT)",
    "app_class": f"CASE WHEN has_parties THEN {by_code('ap', PARTY_KINDS)} END",
    "app_represented": "CASE WHEN has_parties THEN al = 1 END",
    "resp_class": f"CASE WHEN has_parties THEN {by_code('rp', PARTY_KINDS)} END",
    "resp_represented": "CASE WHEN has_parties THEN rl = 1 END",
    "outcome": by_code("oc", [*OUTCOMES, None]),
    "outcome_binary": "CASE WHEN oc IN (0, 2) THEN TRUE WHEN oc IN (1, 3) THEN FALSE END",
    "cited_bger": f"nullif(concat_ws(';', CASE WHEN has_head THEN {_OWN_IN_TEXT} WHEN has_registry THEN own_ref END, "
    "CASE WHEN is_merged THEN other_ref END, CASE WHEN nc > 0 THEN '6P.12/2005' END, CASE WHEN nc > 1 THEN '7A.8/2006' END, "
    "CASE WHEN nc > 2 THEN '9C_71/2012' END), '')",
    "n_cited_bger": "CAST(nc + CASE WHEN has_head OR has_registry THEN 1 ELSE 0 END + CASE WHEN is_merged THEN 1 ELSE 0 END AS BIGINT)",
    "cited_bge": f"nullif(concat_ws(';', {_LEAD}, CASE WHEN nc > 0 THEN '129 II 44' END, CASE WHEN nc > 1 THEN '138 III 7' END, "
    "CASE WHEN nc > 2 THEN '120 II 5' END), '')",
    "n_cited_bge": "CAST(nc + CASE WHEN has_lead THEN 1 ELSE 0 END AS BIGINT)",
    "leading_case": _LEAD,
    "doi_version": q(cb.DOI_VERSION),
    "judge_names": "CASE nj " + " ".join(
        f"WHEN {i} THEN concat_ws(';', {', '.join(judge(j) for j in who)})" for i, who in enumerate(_NAME_LISTS) if who
    ) + " ELSE '' END",
    "parties": "CASE WHEN has_parties THEN concat_ws(' ', p11, p12, p13, p14, p15) END",
    "warnings": f"concat_ws(';', CASE WHEN {_REF} IS NULL THEN 'missing_docref' END, CASE WHEN {_DATE} IS NULL THEN 'missing_date' END, "
    "CASE WHEN nj = 0 THEN 'missing_n_judges' END, CASE WHEN df = 2 THEN 'missing_source_date' END, "
    "CASE WHEN oc = 5 THEN 'missing_outcome' END)",
    "marked_holdings": f"CASE WHEN has_marker THEN {_HOLDINGS} END",
}


def expected_sql(*columns: str, where: str | None = None) -> str:
    """DuckDB query with ``html_id`` and the expected value of each column."""
    listed = ", ".join(f"{EXPECTED[c]} AS {c}" for c in columns)
    condition = f" WHERE {where}" if where else ""
    return f"SELECT html_id, {listed} FROM ({written_sql()}) AS w{condition}"


def written_sql(orders: str = "orders") -> str:
    return WRITTEN_SQL.replace("{orders}", orders)


def written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, lines and registry values of every judgment."""
    columns = ("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    compile_stages(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*columns)
    return spark.sql(WRITTEN_SQL, orders=use_all_cores(orders, pieces=3))


def judgment_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgments as the coding rules take them, with registry columns."""
    lines = F.array(*[F.col(c) for c in LINES])
    return written(spark, sf_dir).select(
        "html_id",
        "raw_html_path",
        F.filter(lines, lambda p: p.isNotNull()).alias("paragraphs"),
        F.col("full_text").alias("text"),
        "reg_docid",
        "reg_url",
        "reg_decision_date",
        "reg_language",
    )


def registry_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log of the judgments' downloads: an older record, the valid one, and a later error without a path."""
    rows = written(spark, sf_dir).where("has_registry")
    records = rows.select(
        "raw_html_path",
        F.explode(
            F.array(
                F.struct(
                    F.lit("aza://old").alias("docid"),
                    F.lit("https://example.test/old").alias("url"),
                    F.lit("1900-01-01").alias("decision_date"),
                    F.lit("xx").alias("language"),
                    F.lit("already_exists").alias("status"),
                    F.lit(1).alias("line_no"),
                ),
                F.struct(
                    F.col("reg_docid").alias("docid"),
                    F.col("reg_url").alias("url"),
                    F.col("reg_decision_date").alias("decision_date"),
                    F.col("reg_language").alias("language"),
                    F.lit("downloaded").alias("status"),
                    F.lit(2).alias("line_no"),
                ),
                F.struct(
                    F.col("reg_docid").alias("docid"),
                    F.col("reg_url").alias("url"),
                    F.lit("2999-01-01").alias("decision_date"),
                    F.lit("yy").alias("language"),
                    F.lit("error").alias("status"),
                    F.lit(3).alias("line_no"),
                ),
            )
        ).alias("r"),
    ).select("raw_html_path", "r.*")
    path = F.when(F.col("status") != "error", F.col("raw_html_path"))
    return records.withColumn("raw_html_path", path)
