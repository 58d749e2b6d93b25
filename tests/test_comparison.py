import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelframe.functions import cells
from gavelframe.operators import comparison as cp
from gavelframe.plans import comparison as run_comparison
from gavelframe.sources import records

PREDICTED = "docref string, date string, year int, outcome string, n_judges int, html_id string, raw_html_path string"


def predictions(spark):
    return spark.createDataFrame(
        [
            ("7B_31/2019", "2019-03-04", 2019, "rejected", 3, "a", "raw/a.html"),
            ("7B_32/2019", "2019-03-05", 2019, "granted", 1, "b", "raw/b.html"),
        ],
        PREDICTED,
    )


def truth(spark):
    return spark.createDataFrame(
        [(1, "7B_31/2019", "2019-03-04", 2019.0, "granted", 3.0)],
        "`Unnamed: 0` int, docref string, date string, year double, outcome string, n_judges double",
    )


@pytest.mark.parametrize("materialise", [True, False])
def test_three_results(spark, materialise):
    result = cp.compare_frames(predictions(spark), truth(spark), materialise=materialise)
    wide = {r["docref"]: r for r in result.comparison.collect()}
    first, second = wide["7B_31/2019"], wide["7B_32/2019"]
    assert first["ground_truth_match_status"] == "matched"
    assert (first["outcome_mismatch"], first["year_mismatch"], first["n_judges_mismatch"]) == (True, False, False)
    assert first["n_mismatched_fields"] == 1
    assert second["ground_truth_match_status"] == "missing_ground_truth"
    assert second["outcome_mismatch"] is None and second["n_mismatched_fields"] == 0
    assert [tuple(r) for r in result.mismatches.collect()] == [
        ("7B_31/2019", "2019-03-04", "outcome", "rejected", "granted", "a", "raw/a.html")
    ]
    summary = {r["field"]: r for r in result.summary.collect()}
    assert list(summary) == ["n_judges", "outcome", "year", "__missing_ground_truth__"]
    assert tuple(summary["outcome"])[1:] == (1, 0, 0.0, 1, 1)
    assert tuple(summary["year"])[1:] == (1, 1, 1.0, 0, 1)
    assert tuple(summary["__missing_ground_truth__"])[1:] == (1, None, None, 1, 1)


def test_no_match_keeps_fields(spark):
    result = cp.compare_frames(predictions(spark).where("docref like '%32/%'"), truth(spark), materialise=False)
    summary = {r["field"]: r for r in result.summary.collect()}
    assert summary["outcome"]["match_rate"] is None and summary["outcome"]["matched_rows"] == 0


def test_null_keys_match_and_duplicates_stop(spark):
    rows = [(None, "2020-01-01", "x"), (None, None, "y")]
    left = spark.createDataFrame(rows, "docref string, date string, v string")
    result = cp.compare_frames(left, left, materialise=False)
    assert {r["ground_truth_match_status"] for r in result.comparison.collect()} == {"matched"}
    with pytest.raises(ValueError, match="predictions has 2 duplicate rows"):
        cp.compare_frames(left.union(left), left)
    with pytest.raises(ValueError, match="missing key columns"):
        cp.validate_keys(left.drop("date"), "x")


def test_cell_equality_follows_kinds(spark):
    def equal(a, a_type, b, b_type):
        schema = T.StructType([T.StructField("a", a_type), T.StructField("b", b_type)])
        frame = spark.createDataFrame([(a, b)], schema)
        return frame.select(cells.cells_equal(F.col("a"), a_type, F.col("b"), b_type)).head()[0]

    text, double, long, flag = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
    assert equal(None, text, float("nan"), double)
    assert equal("", text, "NA", text)
    assert equal(1, long, 1.0, double)
    assert equal("1", text, 1, long)
    assert equal(True, flag, "TRUE", text)
    assert equal(" Penal\n", text, "Penal", text)
    assert equal("\xa01e2\t", text, 100, long)
    assert not equal("Penal", text, "penal", text)
    assert not equal(True, flag, 1, long)
    assert not equal("1d", text, 1, long)


def test_numbers_like_pandas(spark):
    samples = ["1", "+1", "-1", "1e5", ".5", "5.", "inf", "-inf", "Infinity", "iNf", "nan", "NAN", "0x10", "1_000", "1d"]
    samples += ["1e", ".", "1e400", "1 2", "--1", "1,5", "-", "1.5.2", "infinit", "1e5.0", "0.1", "123456789.25", "1e-7"]
    frame = spark.createDataFrame([(s,) for s in samples], "s string")
    got = frame.select("s", cells.cell_key(F.col("s"), T.StringType()), cells.cell_text(F.col("s"), T.StringType())).collect()
    for s, key, shown in got:
        number = pd.to_numeric(s, errors="coerce")
        if s == "nan":
            assert key is None and shown == ""
        elif pd.isna(number):
            assert key == f"s:{s}" and shown == s
        else:
            value = float(number)
            assert key.startswith("n:")
            assert shown == str(int(value) if value.is_integer() else value)


def test_text_keys_look_for_numbers_once(spark):
    """Each cell is searched for a plain number once, and odd cells keep their kinds."""
    want = {
        " \u00a0x ": "s:x", "\u3000NA\t": None, "<NA>": None, " ": None, "": None, "NaNs": "s:NaNs", "tRUE": "b:true", "falsE ": "b:false",
        "+1e400": "s:+1e400", "-0.0": "n:0.0", " .5": "n:0.5", "-INF": "n:-Infinity", "infinity": "n:Infinity", "Info": "s:Info", "+inf": "n:Infinity",
        "1d": "s:1d", "-": "s:-", "~1": "s:~1", "\u00e91": "s:\u00e91", "\u0661": "s:\u0661", "1_0": "s:1_0", "!": "s:!",
    }
    rows = spark.createDataFrame([*want.items(), (None, None)], "cell string, want string").repartition(2)
    keyed = rows.withColumn("key", cells.text_key(cells.stripped(F.col("cell"))))
    assert {r.cell: r.key for r in keyed.collect()} == {**want, None: None}
    lean = keyed.select("key")._jdf.queryExecution().optimizedPlan().toString()
    assert lean.count("(?:[eE][+-]?[0-9]+)?") == 1


def test_csv_run(spark, tmp_path):
    csv = tmp_path / "truth.csv"
    csv.write_text(',docref,date,year,outcome\n1,7B_31/2019,2019-03-04,2019,granted\n2,7B_39/2019,2019-03-09,NA,"a ""b"", c"\n')
    frame = records.read_truth_csv(spark, str(csv))
    assert frame.columns == ["docref", "date", "year", "outcome"]
    rows = frame.orderBy("docref").collect()
    assert rows[1]["year"] is None and rows[1]["outcome"] == 'a "b", c'
    predicted = str(tmp_path / "predicted")
    predictions(spark).select("docref", "date", "year", "outcome").write.parquet(predicted)
    out = [str(tmp_path / name) for name in ("rows", "cells", "summary")]
    totals = run_comparison.run(spark, predicted, str(csv), *out)
    assert totals == {"compared": 2, "missing_ground_truth": 1, "mismatches": 1}
    assert spark.read.parquet(out[0]).count() == 2
    assert spark.read.option("header", True).csv(out[1]).head()["field"] == "outcome"
    assert spark.read.option("header", True).csv(out[2]).count() == 3
