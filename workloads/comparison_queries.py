"""Comparison of predictions with a reference table, on orders and on coded judgments."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelframe.functions import cells
from gavelframe.functions import codebook as cb
from gavelframe.operators import comparison as cp
from gavelframe.session import cut, use_all_cores
from workloads.coding_queries import coded, widen
from workloads.judgments import expected_sql, q, written

QUERIES = {}
ORACLES = {}

# Both sides come from orders. The reference side ends in 2001, is all text,
# and differs from the predictions where the codes below say so.
_PREDICTED = """
  SELECT k, CASE WHEN o_orderpriority = '5-LOW' AND k = o_custkey THEN NULL ELSE 'D' || CAST(k AS VARCHAR(20)) END AS docref,
    day AS date, o_orderstatus AS status, CAST(k % 7 AS INT) AS n_judges, (k % 13) / 4.0 AS ratio, k % 2 = 0 AS flag,
    CASE WHEN k % 11 = 0 THEN NULL ELSE 'Note ' || o_orderpriority END AS note, o_custkey AS customer,
    'h' || CAST(k AS VARCHAR(20)) AS html_id, 'raw/' || CAST(k AS VARCHAR(20)) || '.html' AS raw_html_path
  FROM (SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority,
          CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS day FROM {orders}) AS o
"""
_TRUTH = """
  SELECT docref, date, k AS _c0,
    CASE WHEN k % 5 = 1 THEN 'X' WHEN k % 5 = 2 THEN ' ' || status || ' ' ELSE status END AS status,
    CASE k % 4 WHEN 0 THEN CAST(n_judges + 1 AS VARCHAR(9)) WHEN 1 THEN CAST(n_judges AS VARCHAR(9)) || '.0' ELSE CAST(n_judges AS VARCHAR(9)) END AS n_judges,
    CASE WHEN k % 3 = 0 THEN 'NA' ELSE CAST(CAST(FLOOR(k % 13 / 4.0) AS INT) AS VARCHAR(9)) || '.' || CASE k % 13 % 4 WHEN 0 THEN '0' WHEN 1 THEN '25' WHEN 2 THEN '5' ELSE '75' END END AS ratio,
    CASE k % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'False' WHEN 2 THEN '1' WHEN 3 THEN 'true' ELSE CASE WHEN flag THEN 'true' ELSE 'FALSE' END END AS flag,
    CASE WHEN k % 11 = 0 THEN CASE WHEN k % 2 = 0 THEN '<NA>' ELSE '' END WHEN k % 17 = 0 THEN lower(note) ELSE note END AS note
  FROM {predicted} AS p WHERE date < '2001-01-01'
"""


def predictions(spark, sf_dir):
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*columns)
    return spark.sql(_PREDICTED, orders=use_all_cores(orders))


def truth(spark, sf_dir):
    return spark.sql(_TRUTH, predicted=predictions(spark, sf_dir))


_P = _PREDICTED.replace("{orders}", "orders")
_T = _TRUTH.replace("{predicted}", f"({_P})")

FIELDS = ["flag", "n_judges", "note", "ratio", "status"]
# Does the field differ, by construction of the truth side?
_DIFFERS = {
    "flag": "CASE k % 6 WHEN 0 THEN FALSE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN TRUE ELSE FALSE END",
    "n_judges": "k % 4 = 0",
    "note": "k % 11 <> 0 AND k % 17 = 0",
    "ratio": "k % 3 = 0",
    "status": "k % 5 = 1",
}
_RATIO_TEXT = (
    "CASE WHEN k % 13 % 4 = 0 THEN CAST(k % 13 // 4 AS VARCHAR) ELSE CAST(k % 13 // 4 AS VARCHAR) || '.' || "
    "CASE k % 13 % 4 WHEN 1 THEN '25' WHEN 2 THEN '5' ELSE '75' END END"
)
# Display text of both sides where a field differs.
_SHOWN = {
    "flag": ("CASE WHEN k % 2 = 0 THEN 'True' ELSE 'False' END", "CASE k % 6 WHEN 2 THEN '1' ELSE 'True' END"),
    "n_judges": ("CAST(k % 7 AS VARCHAR)", "CAST(k % 7 + 1 AS VARCHAR)"),
    "note": ("note", "lower(note)"),
    "ratio": (_RATIO_TEXT, "''"),
    "status": ("status", "'X'"),
}
_MATCHED = "date < '2001-01-01'"


def _rows(spark, sf_dir):
    return cp.judge_cells(predictions(spark, sf_dir), truth(spark, sf_dir))


def compare_join(spark, sf_dir):
    joined, _ = cp.join_truth(predictions(spark, sf_dir), truth(spark, sf_dir))
    return joined.select("docref", "date", "html_id", "status_pred", "status_truth", "n_judges_truth", F.col("_found").alias("found"))


QUERIES["compare_join"] = compare_join
ORACLES["compare_join"] = f"""
  SELECT p.docref, p.date, p.html_id, p.status AS status_pred, t.status AS status_truth, t.n_judges AS n_judges_truth,
    t._c0 IS NOT NULL AS found
  FROM ({_P}) AS p LEFT JOIN ({_T}) AS t ON p.docref IS NOT DISTINCT FROM t.docref AND p.date IS NOT DISTINCT FROM t.date"""


def match_status(spark, sf_dir):
    rows, _ = _rows(spark, sf_dir)
    return rows.groupBy(cp.STATUS).agg(F.count("*").alias("n"))


QUERIES["match_status"] = match_status
ORACLES["match_status"] = f"""
  SELECT CASE WHEN {_MATCHED} THEN 'matched' ELSE 'missing_ground_truth' END AS ground_truth_match_status, count(*) AS n
  FROM ({_P}) AS p GROUP BY 1"""


def compare_wide(spark, sf_dir):
    rows, fields = _rows(spark, sf_dir)
    return widen(cp.wide_rows(rows, fields))


QUERIES["compare_wide"] = compare_wide
ORACLES["compare_wide"] = f"""
  SELECT docref, date, html_id, raw_html_path,
    CASE WHEN {_MATCHED} THEN 'matched' ELSE 'missing_ground_truth' END AS ground_truth_match_status,
    {', '.join(f"CASE WHEN {_MATCHED} THEN {_DIFFERS[f]} END AS {f}_mismatch" for f in FIELDS)},
    CAST(CASE WHEN {_MATCHED} THEN {' + '.join(f"CAST(({_DIFFERS[f]}) AS INT)" for f in FIELDS)} ELSE 0 END AS BIGINT) AS n_mismatched_fields
  FROM ({_P}) AS p"""


def mismatch_rows(spark, sf_dir):
    rows, fields = _rows(spark, sf_dir)
    return cp.mismatch_rows(rows, fields)


QUERIES["mismatch_rows"] = mismatch_rows
ORACLES["mismatch_rows"] = " UNION ALL ".join(
    f"SELECT docref, date, '{f}' AS field, {_SHOWN[f][0]} AS predicted_value, {_SHOWN[f][1]} AS ground_truth_value, "
    f"html_id, raw_html_path FROM ({_P}) AS p WHERE {_MATCHED} AND ({_DIFFERS[f]})"
    for f in FIELDS
)


def _round_rate(df):
    return df.withColumn("match_rate", F.round("match_rate", 9))


def compare_summary(spark, sf_dir):
    rows, fields = _rows(spark, sf_dir)
    return _round_rate(cp.summary_rows(rows, fields))


def _summary_sql(base: str, matched: str, differs: dict[str, str]) -> str:
    """One aggregate over ``base`` and one output row per field."""
    counts = ", ".join(f"count(*) FILTER (WHERE {matched} AND ({differs[f]})) AS d{i}" for i, f in enumerate(differs))
    totals = f"SELECT count(*) FILTER (WHERE {matched}) AS m, count(*) FILTER (WHERE NOT ({matched})) AS u, {counts} FROM ({base}) AS b"
    lines = [
        f"SELECT '{f}' AS field, m AS matched_rows, m - d{i} AS matches, "
        f"CASE WHEN m > 0 THEN round((m - d{i}) / m, 9) END AS match_rate, d{i} AS mismatches, u AS missing_ground_truth FROM t"
        for i, f in enumerate(differs)
    ]
    lines.append(
        f"SELECT '{cb.MISSING_TRUTH_FIELD}', m, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), u, u FROM t"
    )
    return f"WITH t AS ({totals}) " + " UNION ALL ".join(lines)


QUERIES["compare_summary"] = compare_summary
ORACLES["compare_summary"] = _summary_sql(_P, _MATCHED, _DIFFERS)


def compare_totals(spark, sf_dir):
    rows, fields = _rows(spark, sf_dir)
    return widen(cp.compare_totals(rows, fields))


QUERIES["compare_totals"] = compare_totals
ORACLES["compare_totals"] = f"""
  SELECT count(*) AS compared, count(*) FILTER (WHERE NOT ({_MATCHED})) AS missing_ground_truth,
    CAST(sum(CASE WHEN {_MATCHED} THEN {' + '.join(f"CAST(({_DIFFERS[f]}) AS INT)" for f in FIELDS)} ELSE 0 END) AS BIGINT) AS mismatches
  FROM ({_P}) AS p"""


def duplicate_keys(spark, sf_dir):
    """Orders keyed by customer and date; customers of one status lose their name."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    keyed = orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("docref"),
        F.date_format("o_orderdate", "yyyy-MM").alias("date"),
    )
    return cp.duplicate_keys(keyed)


QUERIES["duplicate_keys"] = duplicate_keys
ORACLES["duplicate_keys"] = """
  SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS docref, strftime(o_orderdate, '%Y-%m') AS date,
    count(*) - 1 AS surplus FROM orders GROUP BY 1, 2 HAVING count(*) > 1"""


# --- cells -----------------------------------------------------------------

# (text as SQL over k, canonical kind, display text as SQL over k)
_CELLS = [
    ("' ' || CAST(k AS VARCHAR(20)) || ' '", "number", "CAST(k AS VARCHAR(20))"),
    ("CAST(k AS VARCHAR(20)) || '.0'", "number", "CAST(k AS VARCHAR(20))"),
    ("CAST(k AS VARCHAR(20)) || '.50'", "number", "CAST(k AS VARCHAR(20)) || '.5'"),
    ("CAST(k AS VARCHAR(20)) || 'e2'", "number", "CAST(k * 100 AS VARCHAR(20))"),
    ("'tRuE'", "bool", "'True'"),
    ("' false '", "bool", "'False'"),
    ("'NA'", "missing", "''"),
    ("'   '", "missing", "''"),
    ("' <NA> '", "missing", "''"),
    ("' Public ' || CAST(k AS VARCHAR(20)) || ' '", "string", "'Public ' || CAST(k AS VARCHAR(20))"),
    ("CAST(k AS VARCHAR(20)) || 'd'", "string", "CAST(k AS VARCHAR(20)) || 'd'"),
    ("'-inf'", "number", "'-inf'"),
    ("'1e400'", "string", "'1e400'"),
    ("'1_0'", "string", "'1_0'"),
    ("'.5'", "number", "'0.5'"),
    ("'-0.0'", "number", "'0'"),
    ("'0.00001'", "number", "'1e-05'"),
    ("'0.00012'", "number", "'0.00012'"),
    ("'12345678.5'", "number", "'12345678.5'"),
    ("'NAN'", "string", "'NAN'"),
]
_FORM = "(CASE k % 20 " + " ".join(f"WHEN {i} THEN {text}" for i, (text, _, _) in enumerate(_CELLS)) + " END)"
_KIND = "(CASE k % 20 " + " ".join(f"WHEN {i} THEN {q(kind)}" for i, (_, kind, _) in enumerate(_CELLS)) + " END)"
_DISPLAY = "(CASE k % 20 " + " ".join(f"WHEN {i} THEN {shown}" for i, (_, _, shown) in enumerate(_CELLS)) + " END)"


def normalize_cell(spark, sf_dir):
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"))
    rows = keys.select("k", F.expr(_FORM).alias("cell"))
    rows = rows.withColumn("key", cells.cell_key(F.col("cell"), T.StringType()))
    kind = (
        F.when(F.col("key").isNull(), "missing")
        .when(F.startswith("key", F.lit("b:")), "bool")
        .when(F.startswith("key", F.lit("n:")), "number")
        .otherwise("string")
    )
    return rows.select("k", "cell", kind.alias("kind"), cells.key_text(F.col("key")).alias("shown"))


QUERIES["normalize_cell"] = normalize_cell
ORACLES["normalize_cell"] = (
    f"SELECT k, {_FORM} AS cell, {_KIND} AS kind, {_DISPLAY} AS shown FROM (SELECT o_orderkey AS k FROM orders) AS o"
)


def values_equal(spark, sf_dir):
    """Typed cells against text cells: numbers and truth values meet, kinds do not."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    pairs = lines.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("a"),
        F.format_string("%.2f", "l_quantity").alias("b"),
        (F.col("l_returnflag") == "R").alias("c"),
        F.when(F.col("l_returnflag") == "R", "TRUE").when(F.col("l_returnflag") == "A", "0").otherwise(" false").alias("d"),
    )
    types = {f.name: f.dataType for f in pairs.schema.fields}
    same = {
        "same_number": cells.cells_equal(F.col("a"), types["a"], F.col("b"), types["b"]),
        "same_flag": cells.cells_equal(F.col("c"), types["c"], F.col("d"), types["d"]),
        "mixed_kinds": cells.cells_equal(F.col("a"), types["a"], F.col("c"), types["c"]),
    }
    return widen(pairs.select("l_orderkey", "l_linenumber", *[v.alias(k) for k, v in same.items()]))


QUERIES["values_equal"] = values_equal
ORACLES["values_equal"] = """
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, TRUE AS same_number, l_returnflag <> 'A' AS same_flag,
    FALSE AS mixed_kinds FROM lineitem"""


def scale_summary(spark, sf_dir):
    """Every line item against a copy with a changed tax and tightened discount."""
    lines = use_all_cores(spark.read.parquet(f"{sf_dir}/lineitem.parquet")).withColumns(
        {"docref": F.col("l_orderkey").cast("string"), "date": F.concat_ws("/", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("string"))}
    )
    copy = lines.where("l_shipdate < timestamp'2001-06-01'").withColumns(
        {
            "l_tax": F.when(F.col("l_returnflag") == "R", F.col("l_tax") + 1).otherwise(F.col("l_tax")).cast("string"),
            "l_discount": F.when(F.col("l_linestatus") == "O", F.lit(None).cast("double")).otherwise(F.col("l_discount")),
            "l_quantity": F.format_string("%.3f", "l_quantity"),
        }
    )
    kept = ["docref", "date", "l_tax", "l_discount", "l_quantity", "l_extendedprice", "l_returnflag"]
    rows, fields = cp.judge_cells(lines.select(*kept), copy.select(*kept))
    return _round_rate(cp.summary_rows(rows, fields))


QUERIES["compare_lineitems"] = scale_summary
ORACLES["compare_lineitems"] = _summary_sql(
    "SELECT * FROM lineitem",
    "l_shipdate < TIMESTAMP '2001-06-01'",
    {
        "l_discount": "l_linestatus = 'O'",
        "l_extendedprice": "FALSE",
        "l_quantity": "FALSE",
        "l_returnflag": "FALSE",
        "l_tax": "l_returnflag = 'R'",
    },
)


# --- coded judgments against their expected coding -------------------------

_CODED_FIELDS = ["app_class", "area_detailed", "language", "n_judges", "outcome", "source_canton", "source_date"]


def coding_match_rates(spark, sf_dir):
    """Judgments coded from their text, compared with a reference that another coder changed.

    The reference has no judgments from 2025 on, and its coder leaves write-offs
    open and calls every legal person natural.
    """
    predicted = coded(spark, sf_dir, "docref", "date", *_CODED_FIELDS)
    predicted = predicted.withColumns(
        {"docref": F.concat_ws("#", F.coalesce("docref", F.lit("-")), "html_id"), "date": F.coalesce("date", F.lit("-"))}
    )
    # Coded once and written, as a run would; key check and comparison read that.
    predicted = cut(predicted.drop("html_id"), "coded")
    codes = written(spark, sf_dir)
    text = {
        "app_class": "CASE WHEN has_parties THEN CASE WHEN ap = 2 THEN 'state' ELSE 'natural' END ELSE 'NA' END",
        "area_detailed": _spark_case("ar", [*cb.AREA_TERMS, None]),
        "language": "CASE lang WHEN 0 THEN 'de' WHEN 1 THEN 'fr' ELSE 'it' END",
        "n_judges": "CASE nj WHEN 0 THEN '' WHEN 1 THEN '1.0' WHEN 2 THEN '3.0' ELSE '5.0' END",
        "outcome": _spark_case("oc", [*[label for label, _ in cb.OUTCOME_TERMS][:4], None, None]),
        "source_canton": _spark_case("cn", [*cb.CANTON_TERMS, "CH", None]),
        "source_date": "CASE WHEN df < 2 THEN CAST(source_day AS STRING) END",
        "docref": "concat_ws('#', CASE WHEN has_registry OR has_head THEN own_ref ELSE '-' END, html_id)",
        "date": "CASE WHEN has_date OR has_registry THEN CAST(decided AS STRING) ELSE '-' END",
    }
    reference = codes.where("decided < DATE '2025-01-01'").select(*[F.expr(sql).alias(name) for name, sql in text.items()])
    return _round_rate(cp.compare_frames(predicted, reference, materialise=False).summary)


def _spark_case(column: str, values: list[str | None]) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values) if v is not None) + " END"


QUERIES["coding_match_rates"] = coding_match_rates
_CODED_BASE = expected_sql("app_class", "outcome").replace("SELECT html_id,", "SELECT html_id, decided,", 1)
ORACLES["coding_match_rates"] = _summary_sql(
    _CODED_BASE,
    "decided < DATE '2025-01-01'",
    {f: {"app_class": "coalesce(app_class = 'legal', FALSE)", "outcome": "coalesce(outcome = 'writeoff', FALSE)"}.get(f, "FALSE") for f in _CODED_FIELDS},
)
