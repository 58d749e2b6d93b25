"""Runs as a user calls them: repeated, limited, forced, with failures and odd paths."""

import json

import pytest
from pyspark.sql import functions as F

from gavelframe import schemas
from gavelframe.plans import annotation, comparison, discovery, extraction
from gavelframe.session import cut, passing_cuts
from gavelframe.sources import paths, records, sinks
from gavelframe.streaming import folders
from workloads import io_queries

BODY = '<div id="highlight_content"><div class="content"><div class="para">{}</div></div></div>'


def write_pages(root, **texts):
    (root / "aa").mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (root / "aa" / f"{name}.html").write_text(text, encoding="utf-8")
    return str(root)


def texts(spark, folder):
    return {r["html_id"]: r["text"] for r in records.read_extracted(spark, folder).collect()}


def test_forced_and_limited_extraction_replaces_only_what_it_did(spark, tmp_path):
    raw = write_pages(tmp_path / "raw", p1=BODY.format("eins"), p2=BODY.format("zwei"), p3=BODY.format("drei"))
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    extraction.run(spark, raw, out, bad)
    write_pages(tmp_path / "raw", p1=BODY.format("neu"), p2="<p>kaputt</p>")
    assert extraction.run(spark, raw, out, bad, limit=1, force=True) == {"processed": 1, "skipped": 0, "failed": 0}
    assert texts(spark, out) == {"p1": "neu", "p2": "zwei", "p3": "drei"}
    assert extraction.run(spark, raw, out, bad, force=True) == {"processed": 2, "skipped": 0, "failed": 1}
    assert texts(spark, out) == {"p1": "neu", "p2": "zwei", "p3": "drei"}


def test_quarantine_holds_each_page_once_and_lets_it_go(spark, tmp_path):
    raw = write_pages(tmp_path / "raw", p1=BODY.format("eins"), p2="<p>kaputt</p>")
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    for _ in range(3):
        extraction.run(spark, raw, out, bad)
    assert records.read_quarantine(spark, bad).count() == 1
    write_pages(tmp_path / "raw", p2=BODY.format("heil"))
    extraction.run(spark, raw, out, bad)
    assert records.read_quarantine(spark, bad).count() == 0
    assert texts(spark, out) == {"p1": "eins", "p2": "heil"}


def test_listing_can_leave_out_older_files(spark, tmp_path):
    raw = write_pages(tmp_path / "raw", p1=BODY.format("eins"))
    run = extraction.run(spark, raw, str(tmp_path / "out"), str(tmp_path / "bad"), modified_since="2999-01-01")
    assert run == {"processed": 0, "skipped": 0, "failed": 0}


def judgments(spark, *rows):
    known = [{f: None for f in schemas.EXTRACTED.fieldNames()} | dict(zip(("html_id", "raw_html_path", "text"), r, strict=True)) for r in rows]
    return spark.createDataFrame([{**k, "paragraphs": [k["text"]]} for k in known], schemas.EXTRACTED)


def test_judgments_without_id_or_path_are_annotated_in_every_run(spark, tmp_path):
    source, done = str(tmp_path / "in"), [str(tmp_path / n) for n in ("coded", "table", "bad")]
    log = str(tmp_path / "none.jsonl")
    judgments(spark, ("one", "aa/one.html", "x"), (None, None, "lost"), ("same", "aa/same.html", "y"), ("same", "bb/same.html", "z")).write.parquet(source)
    assert annotation.run(spark, source, log, *done)["processed"] == 4
    judgments(spark, (None, None, "lost too")).write.mode("append").parquet(source)
    assert annotation.run(spark, source, log, *done) == {"processed": 2, "skipped": 4, "failed": 0}
    assert annotation.run(spark, source, log, *done, limit=1, force=True)["processed"] >= 1
    assert {r["raw_html_path"] for r in records.read_annotations(spark, done[0]).collect()} == {"", "aa/one.html", "aa/same.html", "bb/same.html"}


@pytest.mark.parametrize("form", ["relative", "absolute", "uri"])
def test_log_and_files_meet_however_paths_are_written(spark, tmp_path, form):
    raw = write_pages(tmp_path / "data" / "raw", p1=BODY.format("eins"))
    path = {"relative": "data/raw/aa/p1.html", "absolute": f"{raw}/aa/p1.html", "uri": f"file://{raw}/aa/p1.html"}[form]
    row = {"docid": "aza://03-02-2011-5D_77-2010", "url": "https://s.test/1", "status": "downloaded", "raw_html_path": path, "decision_date": "2011-02-03"}
    log = tmp_path / "log.jsonl"
    log.write_text(json.dumps(row) + "\n", encoding="utf-8")
    out, bad, coded, table, failed = (str(tmp_path / n) for n in ("out", "bad", "coded", "table", "failed"))
    extraction.run(spark, raw, out, bad)
    annotation.run(spark, out, str(log), coded, table, failed, raw_folder=raw)
    assert tuple(spark.read.parquet(table).select("docref", "url", "date").head()) == ("5D_77/2010", "https://s.test/1", "2011-02-03")

    search = tmp_path / "search"
    search.mkdir()
    link = '<a href="?type=show_document&highlight_docid={}">t</a>'
    page = link.format("aza%3A%2F%2F03-02-2011-5D_77-2010") + link.format("d2") + link.format("d3")
    (search / "search_03.02.2011_03.02.2011_page_10.html").write_text(link.format("d10"), encoding="utf-8")
    for n in range(1, 10):
        (search / f"search_03.02.2011_03.02.2011_page_{n}.html").write_text(page if n == 2 else link.format(f"p{n}"), encoding="utf-8")
    planned, counters = discovery.plan_run(spark, str(search), raw, str(log), "https://s.test/", "2011-02-03", "2011-02-03", limit=4)
    rows = planned.collect()
    assert [r["docid"] for r in rows] == ["p1", "d2", "d3", "p3"]
    assert all(r["target_path"].startswith(f"{raw}/") and r["target_path"].endswith(".html") for r in rows)
    outcomes = [("p1", "downloaded", 200, "x", "h", None), ("d2", "error", None, None, None, "no answer"), ("d3", "teapot", 418, None, None, None)]
    results = spark.createDataFrame(outcomes, "docid string, status string, http_status int, raw_html_path string, content_hash string, message string")
    logged = discovery.log_rows(planned, results.withColumn("scraped_at", F.lit("2020-01-01T00:00:00")))
    assert {r["docid"]: r["error_message"] for r in logged.collect()} == {"p1": None, "d2": "no answer", "d3": "unexpected status: teapot"}
    assert discovery.run_counts(counters, logged) == {"attempted": 3, "downloaded": 1, "errors": 2, "skipped": 8}


def test_path_key_forms(spark):
    root = "/srv/data/raw"
    forms = ["hdfs://host:9000/srv/data/raw/a/b.html", "/srv//data/raw/a/b.html", "./data/raw/a/b.html", "raw/a/b.html", "a/b.html", "file:/srv/data/raw/a/b.html"]
    frame = spark.createDataFrame([(f,) for f in forms], "p string")
    assert {r[0] for r in frame.select(paths.path_key(F.col("p"), root)).collect()} == {"a/b.html"}


def test_later_line_wins_and_odd_types_are_read(spark, tmp_path):
    from gavelframe.operators import registry as rg

    lines = [
        {"docid": "d", "status": "error", "scraped_at": "2024-05-05T00:00:00"},
        {"docid": "d", "status": "downloaded", "http_status": 200.0, "scraped_at": "2020-01-01T00:00:00", "title": {"a": 1}},
        {"docid": "e", "http_status": "oops"},
    ]
    path = tmp_path / "log.jsonl"
    path.write_text("\n".join(map(json.dumps, lines)), encoding="utf-8")
    index = {r["record_key"]: r for r in rg.registry_index(records.read_registry(spark, str(path))).collect()}
    assert (index["d"]["status"], index["d"]["http_status"]) == ("downloaded", 200)
    assert index["e"]["http_status"] is None
    path.write_text(json.dumps(lines[0]) + "\n\n{broken\n", encoding="utf-8")
    with pytest.raises(Exception, match=r"log\.jsonl:3: \{broken"):
        records.read_registry(spark, str(path))


def test_truth_with_line_breaks_in_quotes(spark, tmp_path):
    truth = tmp_path / "truth.csv"
    truth.write_text('Unnamed: 0,docref,date,outcome\n0,1A_1/2001,2001-01-01,"line one\nline ""two"""\n1,1A_2/2001,2001-01-02,granted\n', encoding="utf-8")
    rows = {r["docref"]: r["outcome"] for r in records.read_truth_csv(spark, str(truth)).collect()}
    assert rows == {"1A_1/2001": 'line one\nline "two"', "1A_2/2001": "granted"}
    guess = str(tmp_path / "guess")
    spark.createDataFrame([("1A_1/2001", "2001-01-01", 'line one\nline "two"'), ("1A_2/2001", "2001-01-02", "rejected")], "docref string, date string, outcome string").write.parquet(guess)
    totals = comparison.run(spark, guess, str(truth), *[str(tmp_path / n) for n in ("rows", "cells", "summary")])
    assert spark.read.option("header", True).csv(str(tmp_path / "cells")).count() == 1, totals


def test_earlier_json_annotations_are_taken_over(spark, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"doi_version": "v", "html_id": "a", "raw_html_path": "aa/a.html", "docref": "1A_1/2001"}), encoding="utf-8")
    (folder / "b.json").write_text("{broken", encoding="utf-8")
    coded = str(tmp_path / "coded")
    assert annotation.import_json(spark, str(folder), coded) == {"imported": 1, "unreadable": 1}
    assert [r["docref"] for r in records.read_annotations(spark, coded).collect()] == ["1A_1/2001"]


def test_stream_keeps_failed_annotations(spark, tmp_path):
    source, coded = str(tmp_path / "in"), str(tmp_path / "coded")
    judgments(spark, ("one", "aa/one.html", "x"), ("odd", "aa/odd.html", "y")).write.parquet(source)
    log = tmp_path / "log.jsonl"
    log.write_text(json.dumps({"docid": "d", "url": "u", "status": "downloaded", "raw_html_path": "aa/odd.html", "decision_date": "no date"}), encoding="utf-8")
    folders.annotate_stream(spark, source, str(log), coded, str(tmp_path / "check")).awaitTermination()
    assert [r["html_id"] for r in records.read_annotations(spark, coded).collect()] == ["one"]
    assert [r["html_id"] for r in spark.read.parquet(f"{coded}-quarantine").collect()] == ["odd"]


def test_cuts_of_a_run_are_deleted(spark):
    with passing_cuts(spark):
        table = cut(spark.range(3).toDF("n"), "passing")
        path = table.inputFiles()[0].rsplit("/", 1)[0]
        assert table.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_runs_set_and_restore_the_method_limit(spark):
    from gavelframe.session import compiled_stages

    name = "spark.sql.codegen.hugeMethodLimit"
    own = spark.conf.get(name)
    for before, inside in (("65535", "8000"), ("4000", "4000")):
        spark.conf.set(name, before)
        with compiled_stages(spark):
            assert spark.conf.get(name) == inside
        assert spark.conf.get(name) == before
    spark.conf.set(name, own)


def test_declared_single_byte_charsets(spark):
    from gavelframe.sources import pages as pg

    text = '<html><head>{}<meta charset="{}"></head><body>{}</body></html>'
    far = "<!--" + "x" * 6000 + "-->"
    cases = [("iso-8859-15", "fünf €"), ("windows-1251", "Привет"), ("KOI8-R", "Привет"), ("iso-8859-2", "źdźbło"), ("unknown-9", "für €")]
    rows = [(i, bytearray(text.format(far, name, body).encode(name if "unknown" not in name else "utf-8"))) for i, (name, body) in enumerate(cases)]
    frame = spark.createDataFrame(rows, "i int, content binary").orderBy("i")
    got = frame.select(pg.decode_page(F.col("content")), pg.declared_charset(F.col("content"))).collect()
    assert all(body in r[0] for r, (_, body) in zip(got, cases, strict=True))
    assert [r[1] for r in got] == [name.lower() for name, _ in cases]


def test_small_files_are_written_without_checksum_files(spark, tmp_path):
    """Each file of a checksum costs as much as the file itself; names with several lines stay one file."""
    rows = spark.createDataFrame([(f"n{k}", f'{{"k":{k}}}') for k in range(30)] + [("n3", None), (None, "x")], "name string, value string")
    io_queries._write_one_file_each(rows, str(tmp_path / "files"))
    files = [p for p in (tmp_path / "files").rglob("*") if p.is_file() and p.name != "_SUCCESS"]
    assert not [p for p in files if p.name.endswith(".crc")]
    texts = sorted(p.read_text() for p in files)
    assert len(texts) == 31 and sorted("".join(texts).split()) == sorted(["x", *"".join(f'{{"k":{k}}} ' for k in range(30)).split()])


def test_a_run_keeps_on_disk_only_what_its_results_need(spark, tmp_path, monkeypatch):
    """The prompt's texts are not written without a classifier, and shuffle files go with the write that they serve."""
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own, seen = spark.conf.get(cleanup, "false"), {}

    def watch(df, name, *options):
        seen[name] = (set(df.columns), spark.conf.get(cleanup))
        return cut(df, name, *options)

    monkeypatch.setattr(annotation, "cut", watch)
    source, done = str(tmp_path / "in"), [str(tmp_path / n) for n in ("coded", "table", "bad")]
    judgments(spark, ("one", "aa/one.html", "x")).write.parquet(source)
    assert annotation.run(spark, source, str(tmp_path / "none.jsonl"), *done)["processed"] == 1
    assert seen["annotation"] == ({*schemas.ANNOTATION.fieldNames(), "error_message"}, "true")
    assert spark.conf.get(cleanup, "false") == own


def test_a_compressed_log_is_read_like_a_plain_one(spark, tmp_path):
    rows = spark.createDataFrame([(f"d{k}", None) for k in range(20)], "docid string, url string").repartition(3)
    for codec in (None, "gzip"):
        sinks.append_registry(rows, str(tmp_path / f"log-{codec}"), 1, codec)
    plain, packed = (records.read_registry(spark, str(tmp_path / f"log-{c}")).select("docid", "url", "batch_seq") for c in (None, "gzip"))
    assert all(f.endswith(".json.gz") for f in packed.inputFiles())
    assert sorted(packed.collect()) == sorted(plain.collect()) and packed.count() == 20
