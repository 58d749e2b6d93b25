"""Versioned tables, splittable CSV, declared charsets, incremental reads and the linear tag walk."""

import csv
import io
import random
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gavelframe.functions import html as hx
from gavelframe.plans import annotation, extraction
from gavelframe.session import watched
from gavelframe.sources import pages as pg
from gavelframe.sources import quoted, records, tables
from tests.test_runs import BODY, judgments, texts, write_pages

SCHEMA = "raw_html_path string, v int"


def shard():
    return F.substring_index("raw_html_path", "/", 1)


def key():
    return F.col("raw_html_path")


def frame(spark, **values):
    return spark.createDataFrame([(k.replace("_", "/"), v) for k, v in values.items()], SCHEMA)


def content(spark, folder):
    return {r.raw_html_path: r.v for r in tables.read(spark, folder, SCHEMA).collect()}


def test_append_replace_and_overwrite(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert content(spark, folder) == {}
    tables.append(frame(spark, a_1=1, a_2=2, b_1=3), folder, shard())
    untouched = [p for p in tables.state(spark, folder).pieces if p.endswith("shard=b")]
    tables.replace(frame(spark, a_2=20, c_1=4), folder, shard(), key(), note={"n": 1})
    assert content(spark, folder) == {"a/1": 1, "a/2": 20, "b/1": 3, "c/1": 4}
    now = tables.state(spark, folder)
    assert now.rows == 4 and now.note == {"n": 1} and now.number == 2
    assert set(untouched) < set(now.pieces)
    tables.replace(spark.createDataFrame([], SCHEMA), folder, shard(), key(), gone=frame(spark, b_1=0))
    assert content(spark, folder) == {"a/1": 1, "a/2": 20, "c/1": 4} and tables.state(spark, folder).rows == 3
    tables.overwrite(frame(spark, z_1=9), folder, shard())
    assert content(spark, folder) == {"z/1": 9}
    assert spark.read.parquet(folder).count() == 1


def test_a_batch_of_the_same_name_is_put_in_place(spark, tmp_path):
    folder = str(tmp_path / "t")
    tables.append(frame(spark, a_1=1, b_1=2), folder, shard(), batch="7")
    tables.append(frame(spark, a_1=3), folder, shard(), batch="7")
    assert content(spark, folder) == {"a/1": 3} and tables.state(spark, folder).rows == 1


def test_a_failed_write_keeps_all_old_rows(spark, tmp_path):
    folder = str(tmp_path / "t")
    tables.append(frame(spark, a_1=1, a_2=2, b_1=3), folder, shard())
    boom = F.when(F.col("raw_html_path") == "a/2", F.raise_error(F.lit("disk full")).cast("int")).otherwise(F.col("v"))
    broken = frame(spark, a_1=10, a_2=20).withColumn("v", boom)
    for write in (
        lambda: tables.replace(broken, folder, shard(), key()),
        lambda: tables.append(broken, folder, shard()),
        lambda: tables.overwrite(broken, folder, shard()),
    ):
        with pytest.raises(Exception, match="disk full"):
            write()
        assert content(spark, folder) == {"a/1": 1, "a/2": 2, "b/1": 3}
        assert spark.read.parquet(folder).count() == 3


def test_a_manifest_cut_short_is_passed_over_and_conflicts_stop(spark, tmp_path):
    folder = str(tmp_path / "t")
    tables.append(frame(spark, a_1=1), folder, shard())
    (tmp_path / "t" / "_manifest" / f"{2:012d}").write_text('{"pieces": ["batch=')
    assert content(spark, folder) == {"a/1": 1}
    tables.append(frame(spark, a_2=2), folder, shard())
    assert content(spark, folder) == {"a/1": 1, "a/2": 2}
    with pytest.raises(tables.Conflict):
        tables._commit(spark, folder, 1, [], 0, {})


def test_a_plain_folder_is_adopted_and_many_pieces_are_merged(spark, tmp_path):
    folder = str(tmp_path / "t")
    frame(spark, a_1=1, b_1=2).withColumn("shard", F.lit("x")).write.partitionBy("shard").parquet(folder)
    assert content(spark, folder) == {"a/1": 1, "b/1": 2}
    for n in range(4):
        tables.append(frame(spark, **{f"a_{n + 5}": n}), folder, shard())
    tables.compact(spark, folder, SCHEMA, shard(), most=3)
    state = tables.state(spark, folder)
    assert sum(p.endswith("shard=a") for p in state.pieces) == 1 and state.rows == 6
    assert len(content(spark, folder)) == 6


def test_metrics_come_with_the_write(spark, tmp_path):
    rows, told = watched(spark.range(10), n=F.count(F.lit(1)), most=F.max("id"))
    rows.write.parquet(str(tmp_path / "w"))
    assert (told("n"), told("most")) == (10, 9)


def test_second_run_opens_only_the_new_file(spark, tmp_path, monkeypatch):
    raw = write_pages(tmp_path / "raw", p1=BODY.format("eins"), p2=BODY.format("zwei"), p3=BODY.format("drei"))
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    assert extraction.run(spark, raw, out, bad) == {"processed": 3, "skipped": 0, "failed": 0}
    write_pages(tmp_path / "raw", p4=BODY.format("vier"))
    opened = []
    plain = pg.open_files
    monkeypatch.setattr(pg, "open_files", lambda s, paths: opened.append(list(paths)) or plain(s, paths))
    assert extraction.run(spark, raw, out, bad) == {"processed": 1, "skipped": 3, "failed": 0}
    assert [p.rsplit("/", 1)[1] for p in opened[0]] == ["p4.html"]
    assert len(texts(spark, out)) == 4


def test_long_lists_are_read_with_a_pushed_time(spark, tmp_path, monkeypatch):
    import os

    raw = write_pages(tmp_path / "raw", **{f"p{k}": BODY.format(k) for k in range(4)})
    for k in (0, 1):
        os.utime(tmp_path / "raw" / "aa" / f"p{k}.html", (1e9, 1e9))
    monkeypatch.setattr(extraction, "_BY_NAME", 0)
    listing = pg.list_page_files(spark, raw)
    todo = listing.where("raw_html_path LIKE '%p2%' OR raw_html_path LIKE '%p3%'")
    oldest = todo.agg(F.min("modificationTime")).head()[0]
    read = extraction.read_pending(spark, raw, todo, 2, oldest)
    assert {r.raw_html_path.rsplit("/", 1)[1] for r in read.collect()} == {"p2.html", "p3.html"}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(modificationTime" in plan


def test_changed_files_are_done_again(spark, tmp_path):
    raw = write_pages(tmp_path / "raw", p1=BODY.format("eins"), p2=BODY.format("zwei"))
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    extraction.run(spark, raw, out, bad)
    write_pages(tmp_path / "raw", p1=BODY.format("eins, neu"))
    assert extraction.run(spark, raw, out, bad) == {"processed": 0, "skipped": 2, "failed": 0}
    assert extraction.run(spark, raw, out, bad, changed=True) == {"processed": 1, "skipped": 1, "failed": 0}
    assert texts(spark, out) == {"p1": "eins, neu", "p2": "zwei"}
    assert extraction.run(spark, raw, out, bad, changed=True) == {"processed": 0, "skipped": 2, "failed": 0}


def test_names_with_pattern_characters_are_opened(spark, tmp_path):
    raw = write_pages(tmp_path / "raw", **{"p[1]": BODY.format("eins"), "p*": BODY.format("zwei"), "p ü": BODY.format("drei")})
    assert extraction.run(spark, raw, str(tmp_path / "o"), str(tmp_path / "b"))["processed"] == 3


def test_one_new_judgment_writes_one_shard_of_the_aggregate(spark, tmp_path):
    source, done = str(tmp_path / "in"), [str(tmp_path / n) for n in ("coded", "table", "bad")]
    log = str(tmp_path / "none.jsonl")
    judgments(spark, ("one", "aa/one.html", "x"), ("two", "bb/two.html", "y"), ("three", "cc/three.html", "z")).write.parquet(source)
    annotation.run(spark, source, log, *done)
    before = set(tables.state(spark, done[1]).pieces)
    judgments(spark, ("four", "bb/four.html", "w")).write.mode("append").parquet(source)
    annotation.run(spark, source, log, *done)
    after = set(tables.state(spark, done[1]).pieces)
    assert before < after and [p.rsplit("/", 1)[1] for p in after - before] == ["shard=bb"]
    annotation.run(spark, source, log, *done, force=True)
    assert records.read_aggregate(spark, done[1]).count() == 4
    # A run that was stopped between its two writes is made good by the next one.
    tables.append(records.read_annotations(spark, done[0]).limit(1).withColumn("raw_html_path", F.lit("dd/five.html")), done[0], F.lit("dd"))
    annotation.run(spark, source, log, *done)
    assert records.read_aggregate(spark, done[1]).count() == 5


def multibyte(charset, codec, body):
    return f'<html><head><meta charset="{charset}"></head><body>{body}</body></html>'.encode(codec)


def test_declared_multibyte_charsets(spark):
    cases = [
        ("Shift_JIS", "cp932", "判決文①"), ("gbk", "gbk", "判决书"), ("gb2312", "gb18030", "判决书镕"), ("big5", "big5", "判決書"),
        ("euc-kr", "cp949", "판결문 똠"), ("euc-jp", "euc_jp", "判決"), ("utf-16", "utf-8", "für"), ("no-such-charset", "utf-8", "für"),
        ("no-such-charset", "cp1252", "für"), ("shift_jis", "cp1252", "für 1"),
    ]
    rows = [(i, bytearray(multibyte(*case))) for i, case in enumerate(cases)]
    got = spark.createDataFrame(rows, "i int, content binary").select("i", pg.decode(F.col("content")).alias("p")).orderBy("i").collect()
    for r, (_, _, body) in zip(got, cases, strict=True):
        assert body in r.p.text, cases[r.i]
    assert [r.i for r in got if r.p.problem] == [8] and got[8].p.problem == "Unknown charset: no-such-charset"


def test_pages_of_unknown_charset_enter_the_quarantine(spark, tmp_path):
    folder = tmp_path / "raw" / "aa"
    folder.mkdir(parents=True)
    (folder / "p.html").write_bytes(multibyte("x-odd", "cp1252", BODY.format("für")))
    (folder / "q.html").write_bytes(multibyte("shift_jis", "cp932", BODY.format("判決")))
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    assert extraction.run(spark, str(tmp_path / "raw"), out, bad) == {"processed": 1, "skipped": 0, "failed": 1}
    assert [r.error_message for r in records.read_quarantine(spark, bad).collect()] == ["Unknown charset: x-odd"]
    assert texts(spark, out) == {"q": "判決"}


def made_up_csv(seed, n):
    r = random.Random(seed)
    bits = ["plain", "", "with, comma", 'say "x"', "two\nlines", '\n\n"\n', "été", "a\r\nb", ' "not quoted"', "x" * 50, '"', "\n"]
    out = io.StringIO()
    w = csv.writer(out, lineterminator=r.choice(["\n", "\r\n"]))
    w.writerow(["docref", "date", "note"])
    rows = [[f"r{k}", r.choice(bits), r.choice(bits)] for k in range(n)]
    w.writerows(rows)
    return out.getvalue(), rows


@pytest.mark.parametrize("seed", [1, 2])
def test_csv_with_line_breaks_is_split(spark, tmp_path, seed):
    folder = tmp_path / "csv"
    folder.mkdir()
    for k in (0, 1):
        (folder / f"{k}.csv").write_bytes(made_up_csv(seed + k, 1500)[0].encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = quoted.read_csv(spark, str(folder))
        assert spark.read.option("lineSep", "\n").text(str(folder)).rdd.getNumPartitions() > 8
        want = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(folder))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")


def test_quotes_inside_plain_fields_are_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('docref,note\na,5" pipe\nb,"q ""x"" y\nz"\n\nc,"end"\n')
    rows = {r.docref: r.note for r in quoted.read_csv(spark, str(path)).collect()}
    assert rows == {"a": '5" pipe', "b": 'q "x" y\nz', "c": "end"}


def test_an_open_quote_is_an_error_with_its_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted, "_LONGEST", 50)
    path = tmp_path / "t.csv"
    path.write_text('docref,note\na,"open\n' + "x,y\n" * 100)
    with pytest.raises(PySparkException, match="is not closed"):
        quoted.read_csv(spark, str(path)).collect()


def test_tag_walk_is_linear():
    start = time.perf_counter()
    for body in ("<span>" * 80_000, "".join(f"<t{k}>" for k in range(80_000)) + "</zz>" * 80_000, "<b></i>" * 80_000):
        container, _ = hx.cut_page(f'<div id="highlight_content"><div class="content">{body}', hx.COURT_LAYOUT)
        assert container == body
    assert time.perf_counter() - start < 5


def test_unquoted_value_with_a_slash_closes_nothing():
    layout = hx.PageLayout((hx.Element("main"),), hx.Element("a"))
    page = "<main><a href=/x/>one</a><a href='y' />two<a title=b/ id=c>three</a></main>tail"
    assert hx.cut_page(page, layout) == ("<a href=/x/>one</a><a href='y' />two<a title=b/ id=c>three</a>", ["one", "three"])


def test_long_numeric_references(spark):
    frame = spark.createDataFrame([("&#0000000228;&#x0000000E4;&#99999999999;&#xFFFFFFFFFF;",)], "s string")
    assert frame.select(hx.unescape(F.col("s"))).head()[0] == "ää&#99999999999;&#xFFFFFFFFFF;"
