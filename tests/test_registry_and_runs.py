import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gavelframe import schemas
from gavelframe.functions import dates
from gavelframe.operators import incremental as inc
from gavelframe.operators import registry as rg
from gavelframe.operators import replies as rp
from gavelframe.plans import annotation, extraction
from gavelframe.session import shared_folder
from gavelframe.sources import records, sinks
from gavelframe.streaming import folders
from tests import fixtures
from tests.test_pages import PAGE

DECISION = "docid string, title string, url string, decision_date date, search_page_path string, source string, language string, court string"


def write_lines(path, *lines):
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n", encoding="utf-8")
    return str(path)


def test_latest_record_wins_and_blank_lines(spark, tmp_path):
    path = write_lines(
        tmp_path / "registry.jsonl",
        {"docid": "aza://x", "status": "error", "url": "u1"},
        "",
        {"docid": "aza://x", "status": "downloaded", "url": "u2", "raw_html_path": "p"},
        {"docid": "", "status": "skipped", "url": "u3"},
        {"status": "lost"},
    )
    index = {r["record_key"]: r for r in rg.registry_index(records.read_registry(spark, path)).collect()}
    assert set(index) == {"aza://x", "u3"}
    assert (index["aza://x"]["status"], index["aza://x"]["url"]) == ("downloaded", "u2")
    assert records.read_registry(spark, str(tmp_path / "absent.jsonl")).count() == 0


def test_malformed_lines(spark, tmp_path):
    path = write_lines(tmp_path / "registry.jsonl", {"docid": "a"}, "", "not-json", "[1]", {"docid": "b"})
    with pytest.raises(PySparkException, match="Invalid JSONL record"):
        records.read_registry(spark, path).collect()
    assert records.read_registry(spark, path, strict=False).count() == 2
    bad = records.malformed_lines(spark, path).orderBy("line_number").collect()
    assert [(r["line_number"], r["value"]) for r in bad] == [(3, "not-json"), (4, "[1]")]
    assert all(r["file"].endswith("registry.jsonl") for r in bad)


def test_line_numbers_over_many_splits(spark, tmp_path):
    lines = [{"docid": f"d{i}", "title": "x" * 50} for i in range(3000)]
    lines[2500] = "broken"
    path = write_lines(tmp_path / "registry.jsonl", *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert [r["line_number"] for r in records.malformed_lines(spark, path).collect()] == [2501]
        log = records.read_registry(spark, path, strict=False)
        assert log.rdd.getNumPartitions() > 3
        ordered = [r["docid"] for r in log.orderBy("line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert ordered == [f"d{i}" for i in range(3000) if i != 2500]


def test_download_plan_truth_table(spark):
    decisions = spark.createDataFrame(
        [(d, "t", u, None, "s", "bger", "de", "BGer") for d, u in (("done", "u1"), ("gone", "u2"), ("bad", "u3"), ("new", "u4"), ("byurl", "u5"))],
        DECISION,
    )
    log = spark.createDataFrame(
        [
            ("done", "u1", "downloaded", "f1", 1),
            ("gone", "u2", "already_exists", "f2", 2),
            ("bad", "u3", "downloaded", "f1", 3),
            ("bad", "u3", "error", None, 4),
            ("", "u5", "downloaded", "f1", 5),
        ],
        "docid string, url string, status string, raw_html_path string, line_no int",
    )
    index, files = rg.registry_index(log), spark.createDataFrame([("f1",)], "raw_html_path string")

    def plan(**options):
        return sorted(r["docid"] for r in rg.download_plan(decisions, index, files, **options).collect())

    assert plan() == ["gone", "new"]
    assert plan(retry_errors=True) == ["bad", "gone", "new"]
    assert plan(force=True) == ["bad", "byurl", "done", "gone", "new"]
    assert [r["record_key"] for r in rg.existing_downloads(index, files).orderBy("record_key").collect()] == ["done", "u5"]


def test_dates(spark):
    samples = {
        "1.2.07": "2007-02-01", "1/2/51": "1951-02-01", "31.02.2007, 1. Mai 2007": None, "am 1er AVRIL 2008": "2008-04-01",
        "3 foo 2008": None, "30. Dezember 1999": "1999-12-30", "5.6.999": "0999-06-05", "none": None,
    }
    frame = spark.createDataFrame([(k,) for k in samples], "s string")
    got = {r[0]: r[1] for r in frame.select("s", dates.iso(dates.parse_date_text(F.col("s")))).collect()}
    assert got == samples
    row = spark.range(1).select(
        dates.days_between(F.lit("2018-05-03"), F.lit("2017-08-16")),
        dates.days_between(F.lit("2018-05"), F.lit("2017-08-16")),
        dates.parse_day_argument(F.lit("01.09.2015")).cast("string"),
        dates.parse_day_argument(F.lit("2015-09-01")).cast("string"),
        dates.parse_day_argument(F.lit("2015/09/01")).cast("string"),
    ).head()
    assert tuple(row) == (260, None, "2015-09-01", "2015-09-01", None)


def test_limit_and_pending(spark):
    rows = spark.createDataFrame([("c",), ("a",), (None,), ("b",)], "raw_html_path string")
    done = spark.createDataFrame([("a",), (None,)], "raw_html_path string")
    left = inc.pending(rows, done, "raw_html_path")
    assert sorted(str(r[0]) for r in left.collect()) == ["None", "b", "c"]
    assert [r[0] for r in inc.limit_pending(left.where("raw_html_path is not null"), 1).collect()] == ["b"]
    with pytest.raises(ValueError):
        inc.limit_pending(rows, -1)


REPLY = {
    "area_detailed": "Vertragsrecht", "area_intermediate": "Obligationenrecht und Handelsrecht", "area_general": "Privatrecht",
    "app_class": "natural", "resp_class": "legal", "outcome": "inadmissible", "confidence": 0.55, "evidence": "two words",
}


def test_replies_fill_only_what_is_open(spark):
    from gavelframe.operators import coding

    frame = coding.without_registry(fixtures.from_paragraphs(spark, ["nothing"], fixtures.GERMAN, ["also nothing"]))
    coded = coding.annotate(frame)
    answers = spark.createDataFrame(
        [("0", json.dumps(REPLY)), ("1", json.dumps(REPLY)), ("2", '{"confidence": 2}')], "html_id string, reply string"
    )
    rows = {r["html_id"]: r for r in rp.merge_replies(coded, answers).collect()}
    assert (rows["0"]["area_detailed"], rows["0"]["outcome"], rows["0"]["outcome_binary"]) == ("Vertragsrecht", "inadmissible", False)
    assert rows["0"]["confidence"]["area_detailed"] == 0.55 and rows["0"]["evidence"]["outcome"] == "two words"
    assert (rows["1"]["outcome"], rows["1"]["app_class"], rows["1"]["confidence"]) == ("rejected", "natural", {})
    assert rows["2"]["outcome"] is None
    assert rows["2"]["warnings"][-1] == "llm_failed:confidence is outside 0..1"


def page_folder(tmp_path):
    raw = tmp_path / "raw" / "2b"
    raw.mkdir(parents=True)
    (raw / "one.html").write_text(PAGE, encoding="utf-8")
    (raw / "two.html").write_text("<p>no judgment</p>", encoding="utf-8")
    return tmp_path / "raw"


def test_extract_and_annotate_runs(spark, tmp_path):
    raw = page_folder(tmp_path)
    extracted, bad = str(tmp_path / "extracted"), str(tmp_path / "bad")
    assert extraction.run(spark, str(raw), extracted, bad) == {"processed": 1, "skipped": 0, "failed": 1}
    (raw / "2b" / "three.html").write_text(PAGE, encoding="utf-8")
    again = extraction.run(spark, str(raw), extracted, bad)
    assert (again["processed"], again["skipped"]) == (1, 1)
    assert sorted(r["html_id"] for r in records.read_extracted(spark, extracted).collect()) == ["one", "three"]

    registry = str(tmp_path / "registry.jsonl")
    coded, table, failed = (str(tmp_path / n) for n in ("coded", "table", "failed"))
    assert annotation.run(spark, extracted, registry, coded, table, failed, limit=1) == {"processed": 1, "skipped": 0, "failed": 0}
    assert annotation.run(spark, extracted, registry, coded, table, failed) == {"processed": 1, "skipped": 1, "failed": 0}
    out = records.read_aggregate(spark, table)
    assert out.columns == schemas.AGGREGATE.fieldNames()
    assert {(r["html_id"], r["date"], r["warnings"].split(";")[0]) for r in out.collect()} == {
        ("one", "2012-10-05", "missing_docref"),
        ("three", "2012-10-05", "missing_docref"),
    }


def test_streams_read_new_files_only(spark, tmp_path):
    raw = page_folder(tmp_path)
    extracted, bad, coded = (str(tmp_path / n) for n in ("extracted", "bad", "coded"))
    for expected in (1, 2):
        folders.extract_stream(spark, str(raw), extracted, bad, str(tmp_path / "c1")).awaitTermination()
        assert spark.read.parquet(extracted).count() == expected
        log = records.read_registry(spark, str(tmp_path / "registry.jsonl"))
        folders.annotate_stream(spark, extracted, log, coded, str(tmp_path / "c2")).awaitTermination()
        assert records.read_annotations(spark, coded).count() == expected
        (raw / "2b" / "three.html").write_text(PAGE, encoding="utf-8")


def test_append_registry_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("a", "u", "error")], "docid string, url string, status string")
    sinks.append_registry(rows, path, 1)
    sinks.append_registry(rows.withColumn("status", F.lit("downloaded")), path, 2)
    schema = "docid string, url string, status string, batch_seq long"
    from pyspark.sql.types import _parse_datatype_string

    back = records.read_registry(spark, path, _parse_datatype_string(schema))
    assert rg.registry_index(back).head()["status"] == "downloaded"


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark)


def test_later_part_of_a_batch_wins(spark, tmp_path):
    """Part files of one batch: the later part has the later record, though its lines begin anew."""
    path = str(tmp_path / "log")
    rows = [(f"d{k % 5}", f"s{k:03d}") for k in range(400)]
    frame = spark.createDataFrame(rows, "docid string, status string").coalesce(1)
    parts = frame.withColumn("k", F.substring("status", 2, 3).cast("int")).repartitionByRange(7, "k").sortWithinPartitions("k").drop("k")
    sinks.append_registry(parts, path, 1)
    index = rg.registry_index(records.read_registry(spark, path)).collect()
    assert {r["record_key"]: r["status"] for r in index} == {f"d{k}": f"s{395 + k:03d}" for k in range(5)}


def test_outcomes_meet_decisions_by_url_and_once(spark):
    rows = [("a", "t", "u1", None, "s1", "bger", "de", "BGer"), ("a", "t", "u1", None, "s2", "bger", "de", "BGer"), (None, "t", "u2", None, "s", "bger", "de", "BGer"), ("", "t", "u3", None, "s", "bger", "de", "BGer")]
    decisions = spark.createDataFrame(rows, DECISION)
    from gavelframe.plans import discovery

    outcomes = spark.createDataFrame(
        [("a", None, "downloaded", 200, "p1", "h", "x", None), (None, "u2", "downloaded", 200, "p2", "h", "x", None), ("", "u3", "error", None, None, None, "x", "no")],
        "docid string, url string, status string, http_status int, raw_html_path string, content_hash string, scraped_at string, message string",
    )
    logged = discovery.log_rows(decisions, outcomes).collect()
    assert sorted((r["url"], r["status"], r["error_message"]) for r in logged) == [("u1", "downloaded", None), ("u2", "downloaded", None), ("u3", "error", "no")]


def test_state_follows_the_log_by_new_files_alone(spark, tmp_path):
    from gavelframe.plans import registry as plan

    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    assert plan.refresh(spark, log, state) == {"files": 0, "keys": 0}
    rows = [(f"d{k % 7}", f"u{k}", f"s{k:03d}") for k in range(60)] + [(None, "u-only", "x"), (None, None, "lost")]
    frame = spark.createDataFrame(rows, "docid string, url string, status string").repartition(3, "status")
    sinks.append_registry(frame, log, 1)
    assert plan.refresh(spark, log, state)["keys"] == 8
    assert plan.refresh(spark, log, state) == {"files": 0, "keys": 0}
    sinks.append_registry(spark.createDataFrame([("d3", "u", "new")], "docid string, url string, status string"), log, 2)
    assert plan.refresh(spark, log, state) == {"files": 1, "keys": 1}
    whole = rg.registry_index(records.read_registry(spark, log))
    columns = ["record_key", "docid", "url", "status", "batch_seq", "file_name", "line_no"]
    assert sorted(map(str, plan.index(spark, state).select(*columns).collect())) == sorted(map(str, whole.select(*columns).collect()))


def test_state_reads_a_longer_file_again(spark, tmp_path):
    from gavelframe.plans import registry as plan

    state = str(tmp_path / "state")
    path = write_lines(tmp_path / "registry.jsonl", {"docid": "a", "status": "error"}, {"docid": "b", "status": "error"})
    assert plan.refresh(spark, path, state) == {"files": 1, "keys": 2}
    with open(path, "a", encoding="utf-8") as file:
        file.write(json.dumps({"docid": "a", "status": "downloaded"}) + "\n")
    plan.refresh(spark, path, state)
    assert {r.record_key: r.status for r in plan.index(spark, state).collect()} == {"a": "downloaded", "b": "error"}
    with open(path, "a", encoding="utf-8") as file:
        file.write("{broken\n")
    with pytest.raises(PySparkException, match="registry.jsonl:4"):
        plan.refresh(spark, path, state)
    assert plan.index(spark, state).count() == 2
