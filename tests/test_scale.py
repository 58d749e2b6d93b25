import pytest
from pyspark.sql import functions as F

from gavelframe.functions import codebook as cb
from gavelframe.functions import text as tx
from gavelframe.operators import coding
from gavelframe.operators import extraction as ex
from gavelframe.operators import registry as rg
from gavelframe.sources import pages as pg
from gavelframe.sources import paths
from workloads import io_queries as io


def test_one_file_for_each_name_in_few_folders(spark, tmp_path):
    rows = spark.createDataFrame([(str(i % 200), f"v{i}") for i in range(201)] + [(None, "x"), (None, "x")], "name string, value string")
    io._write_one_file_each(rows, f"{tmp_path}/out")
    files = list(tmp_path.glob("out/*/part-*.txt"))
    assert len(files) == 201
    assert len(list(tmp_path.glob("out/part=*"))) <= 64
    assert sorted(len(f.read_text().splitlines()) for f in files)[-2:] == [2, 2]


def test_page_files_lie_in_few_shards_and_keep_their_names(spark, tmp_path):
    rows = spark.range(600).select(F.col("id").cast("string").alias("url"), F.concat(F.lit("<p>"), "id").alias("html"))
    rows = rows.withColumn("raw_html_path", paths.digest_path("raw", F.lit(""), F.col("url")))
    io._write_page_files(spark, rows, f"{tmp_path}/raw")
    listing = pg.list_page_files(spark, f"{tmp_path}/raw", ".txt")
    named = listing.select(io._page_name("raw_html_path").alias("name"), paths.shard(F.col("raw_html_path")).alias("shard"))
    told = named.agg(F.count_distinct("name"), F.count_distinct("shard"), F.count("*")).head()
    assert (told[0], told[2]) == (600, 600) and told[1] <= 256
    expected = rows.select(paths.digest(F.lit(""), F.col("url")).alias("name"))
    assert named.select("name").exceptAll(expected).isEmpty()


def test_pages_reach_python_in_batches_of_bounded_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64MB")
        ex.with_container(spark.createDataFrame([("<p>a</p>",)], "html string"))
        assert int(spark.conf.get(name).rstrip("b")) == 8 << 20
        spark.conf.set(name, str(1 << 20))
        ex.with_container(spark.createDataFrame([("<p>a</p>",)], "html string"))
        assert int(spark.conf.get(name).rstrip("b")) == 1 << 20
    finally:
        spark.conf.set(name, before)


def test_error_messages_are_cut_before_the_join(spark):
    decision = "docid string, title string, url string, decision_date date, search_page_path string, source string, language string, court string"
    wanted = spark.createDataFrame([("d", "t", "u", None, "s", "bger", "de", "BGer")], decision)
    failures = spark.createDataFrame([("d", "m" * 5000, "now")], "docid string, message string, scraped_at string")
    rows = rg.error_rows(wanted, failures)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("substring(message")
    assert len(rows.head()["error_message"]) == 2000


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_text_made_of_its_paragraphs_is_folded_once(spark):
    rows = [
        ("a", ["Straße  ΟΔΟΣ", "", None, "\u00a0Ｂ\tﬁn ẞ"], "Straße  ΟΔΟΣ\n\n\u00a0Ｂ\tﬁn ẞ"),
        ("b", ["ΟΔΟΣ", "Ende "], "ΟΔΟΣ\nEnde"),
        ("c", ["kurz"], "Ein anderer  TEXT\r\nΟΔΟΣ"),
        ("d", ["x" * 2990, "İSTANBUL ΟΔΟΣ"], "x" * 2990 + "\nİSTANBUL ΟΔΟΣ"),
        ("e", [" ", "\x1c"], " \n\x1c"),
        ("f", [], ""),
    ]
    df = spark.createDataFrame(rows, "id string, paragraphs array<string>, text string")
    df = df.withColumn("folded", F.transform("paragraphs", tx.fold))
    start = coding.folded_start(F.col("text"), F.col("paragraphs"), F.col("folded"), cb.AREA_CHARS)
    old = tx.fold(F.substring("text", 1, cb.AREA_CHARS))
    assert df.select(start.alias("new"), old.alias("old")).where("NOT new <=> old").isEmpty()
    # The folded paragraphs decide alone: with others in their place, another text comes out.
    other = coding.folded_start(F.col("text"), F.col("paragraphs"), F.array(F.lit("known")), cb.AREA_CHARS)
    assert {r[0] for r in df.where(other == "known").select("id").collect()} == {"a", "b", "e", "f"}


def test_section_stops_are_tested_once(spark):
    df = spark.createDataFrame([(["a", "b", "c"], [False, True, True]), (["a"], [False]), (["a"], None), (None, None)], "x array<string>, s array<boolean>")
    cut = df.select(tx.take_until(F.col("x"), F.transform("s", lambda s: s & F.lit(True))).alias("cut"))
    assert [r["cut"] for r in cut.collect()] == [["a"], ["a"], [], None]
    assert _plan(cut).count("array_position") == 1


@pytest.mark.parametrize("terms", [t for t in cb.AREA_TERMS.values()] + [cb.STATE_TERMS, cb.LAWYER_TERMS, cb.LEGAL_TERMS])
def test_terms_are_found_wherever_they_stand(terms):
    for term in terms:
        rest = tx._from_rarest(term)
        assert term.endswith(rest) and len(rest) >= min(4, len(term))


def test_terms_are_searched_from_a_rare_letter_and_not_twice(spark):
    terms = ("invalidenversicherung", "vertrag", "mietvertrag", "vertrag")
    texts = ["die invalidenversicherung", "validenversicherung", "mietvertrag", "vertra", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    hit = df.select(tx.contains_any(F.col("t"), terms).alias("hit"))
    assert [r["hit"] for r in hit.collect()] == [True, False, True, False, False, None]
    assert "mietvertrag" not in _plan(hit) and "Contains(t#" in _plan(hit).replace("contains", "Contains")
