import pytest
from pyspark.sql import functions as F

from gavelframe.functions import html as hx
from gavelframe.functions import text as tx
from gavelframe.functions import urls
from gavelframe.functions.html import COURT_LAYOUT
from gavelframe.operators import extraction as ex
from gavelframe.operators import links as lk
from gavelframe.plans import discovery
from gavelframe.sources import pages as pg
from gavelframe.sources import paths

PAGE = """
<html><head><script>var a = "<div class='para'>no</div>";</script></head>
  <body>
    <div>menu<div>deep</div></div>
    <div id="highlight_content" class="box">
      <div class="content">
        <div class="para">Corte suprema&nbsp;</div>
        <div class="para">&nbsp;</div>
        <!-- <div class="para">hidden</div> -->
        <div class="big para x">Urteil vom <b>5.</b> Oktober<br>2012</div>
        <div class="parade">not a paragraph</div>
      </div>
    </div>
    <div class="para">footer</div>
  </body>
</html>
"""


def extract(spark, *pages):
    rows = spark.createDataFrame([(f"data/raw/judgments/2b/p{i}.html", p) for i, p in enumerate(pages)], "raw_html_path string, html string")
    return ex.extract_pages(rows, COURT_LAYOUT).orderBy("raw_html_path").collect()


def test_extraction_record(spark):
    row = extract(spark, PAGE)[0]
    assert row["paragraphs"] == ["Corte suprema", "Urteil vom 5. Oktober 2012"]
    assert row["text"] == "Corte suprema\nUrteil vom 5. Oktober 2012"
    assert row["html_id"] == "p0"
    assert (row["paragraph_count"], row["char_count"]) == (2, len(row["text"]))
    assert (row["selector"], row["paragraph_selector"]) == ("#highlight_content > .content", "div.para")
    assert row["error_message"] is None


def test_container_edge_cases(spark):
    inner = '<div id="highlight_content"><div class="content">%s</div></div><div class="para">out</div>'
    nested = inner % '<div><div class="para">a<div>b</div>c</div></div><div class="para">d</div>'
    bare = inner % "only &amp;lt; text &#233;&#x20AC;&unknown;"
    empty = inner % ""
    unclosed = '<div id="highlight_content"><div class="content"><div class="para">a</div><div class="para">b'
    rows = extract(spark, nested, bare, empty, unclosed, "<div>none</div>")
    assert rows[0]["paragraphs"] == ["a b c", "d"]
    assert rows[1]["paragraphs"] == ["only &lt; text é€&unknown;"]
    assert rows[2]["paragraphs"] == [] and rows[2]["error_message"] is None
    assert rows[3]["paragraphs"] == ["a", "b"]
    assert rows[4]["error_message"].startswith("Could not find judgment content")


def test_long_page_does_not_overflow(spark):
    body = "".join(f'<div class="para">line {i} <b>x</b></div>' for i in range(30000))
    row = extract(spark, f'<div id="highlight_content"><div class="content">{body}</div></div>')[0]
    assert row["paragraph_count"] == 30000


def test_decode(spark):
    text = '<html><head><meta charset="UTF-8"></head><body>Nach Übereinkunft – gültig</body></html>'
    cases = [
        text.encode("utf-8"),
        text.encode("cp1252"),
        b"\xef\xbb\xbf" + text.encode("utf-8"),
        text.encode("utf-16"),
        text.replace("UTF-8", "windows-1252").encode("cp1252"),
    ]
    rows = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(cases)], "i int, content binary")
    got = [r[0] for r in rows.orderBy("i").select(pg.decode_page(F.col("content"))).collect()]
    assert all("Übereinkunft – gültig" in g for g in got)


def test_paths(spark):
    row = (
        spark.range(1)
        .select(
            paths.extracted_path(F.lit("pages/raw/7e/7e01aa55cc90f3d2.html"), "pages/raw", "out").alias("a"),
            paths.reroot(F.lit("elsewhere/x.html"), "data", "out").alias("b"),
            paths.digest_path("d", F.lit(""), F.lit("u")).alias("c"),
            paths.digest_path("d", F.lit("u"), F.lit("other")).alias("e"),
            paths.file_stem(F.lit("a/b.c.html")).alias("f"),
        )
        .head()
    )
    assert row["a"] == "out/7e/7e01aa55cc90f3d2.json"
    assert row["b"] is None
    assert row["c"] == row["e"] and len(row["c"]) == len("d/xx/0123456789abcdef.html")
    assert row["f"] == "b.c"


@pytest.mark.parametrize(
    ("href", "expected"),
    [
        ("", "https://h.test/a/b?x=1#f"),
        ("?q=2", "https://h.test/a/b?q=2"),
        ("#g", "https://h.test/a/b?x=1#g"),
        ("/c", "https://h.test/c"),
        ("c?y", "https://h.test/a/c?y"),
        ("../c/./d", "https://h.test/c/d"),
        ("../../../c/", "https://h.test/c/"),
        ("//o.test/z", "https://o.test/z"),
        ("http://o.test/z", "http://o.test/z"),
    ],
)
def test_join_url(spark, href, expected):
    frame = spark.createDataFrame([("https://h.test/a/b?x=1#f", href)], "b string, h string")
    assert frame.select(urls.join_url(F.col("b"), F.col("h"))).head()[0] == expected


SEARCH = (
    '<a href="?type=show_document&highlight_docid=aza%3A%2F%2Fone">01.01.2020  1C_1/2020</a>'
    '<a href="?type=show_document&amp;highlight_docid=aza%3A%2F%2Fone">again</a>'
    '<a href="?type=show_document&highlight_docid=aza%3A%2F%2Ftwo">zur <b>Publiziert</b></a>'
    '<a href="/show?type=show_document">no id</a><a name="x">none</a><a href="/other">other</a>'
)


def test_links(spark):
    pages = spark.createDataFrame([("p", SEARCH)], "page string, html string")
    links = lk.first_link_wins(lk.page_links(pages, F.lit("https://h.test/i.php")), ["page"]).orderBy("position").collect()
    assert [r["docid"] for r in links] == ["aza://one", "https://h.test/show?type=show_document"]
    assert links[0]["title"] == "01.01.2020 1C_1/2020"
    assert links[0]["url"] == "https://h.test/i.php?type=show_document&highlight_docid=aza%3A%2F%2Fone"


def test_discovery_stops_at_first_page_without_links(spark):
    def name(day, page):
        return f"s/search_{day}_{day}_page_{page}.html"

    link = '<a href="?type=show_document&highlight_docid=d{}">t</a>'
    rows = [
        (name("01.01.2020", 1), link.format(1)),
        (name("01.01.2020", 2), "<p>no results</p>"),
        (name("01.01.2020", 3), link.format(3)),
        (name("02.01.2020", 2), link.format(4)),
        (name("03.01.2020", 1), link.format(5)),
        (name("03.01.2020", 2), link.format(6)),
        (name("03.01.2020", 3), link.format(7)),
        (name("04.01.2020", 1), link.format(8)),
    ]
    pages = spark.createDataFrame(rows, "raw_html_path string, html string")
    found = discovery.discovered(pages, "https://h.test/", "2020-01-01", "2020-01-03", max_pages_per_day=2)
    assert sorted(r["docid"] for r in found.collect()) == ["d1", "d5", "d6"]
    with pytest.raises(ValueError):
        discovery.discovered(pages, "https://h.test/", "2020-01-02", "2020-01-01")
    with pytest.raises(ValueError):
        discovery.discovered(pages, "https://h.test/", "2020-01-01", "2020-01-02", max_pages_per_day=0)


def test_day_range(spark):
    days = [str(r[0]) for r in lk.day_range(spark, "2020-02-28", "2020-03-01").collect()]
    assert days == ["2020-02-28", "2020-02-29", "2020-03-01"]
    with pytest.raises(ValueError):
        lk.day_range(spark, "2020-02-02", "2020-02-01")


def test_squeeze_and_fold(spark):
    samples = ["a\xa0 b\x1c c", "  x  ", "plain text", "Straße OﬃCE", "", "　", "ARRÊT\tDU"]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string").orderBy("i")
    got = frame.select(tx.squeeze(F.col("s")), tx.fold(F.col("s")), tx.strip_blanks(F.col("s"))).collect()
    for sample, row in zip(samples, got, strict=True):
        even = " ".join(sample.split())
        assert tuple(row) == (even, even.casefold(), sample.strip())


def test_unescape_once(spark):
    frame = spark.createDataFrame([("&amp;nbsp;&Auml;&#65;",)], "s string")
    assert frame.select(hx.unescape(F.col("s"))).head()[0] == "&nbsp;ÄA"


@pytest.mark.parametrize("levels", [1, 13, 200])
def test_any_nesting_keeps_paragraphs_and_drops_the_footer(spark, levels):
    deep = "<div>" * levels + "tief" + "</div>" * levels
    page = f'<div id="highlight_content"><div class="content"><div class="para">a {deep} b</div><div class="para">c</div></div></div><div class="para">out</div>'
    assert extract(spark, page)[0]["paragraphs"] == ["a tief b", "c"]


def test_selectors_take_any_tag_but_only_true_children(spark):
    other_tags = '<section id="highlight_content"><main class="x content"><div class="para">a</div></main></section>'
    grandchild = '<div id="highlight_content"><span><div class="content"><div class="para">a</div></div></span></div>'
    nested_blocks = '<div id="highlight_content"><div class="content"><div class="para">a<div class="para">b</div></div></div></div>'
    quoted = """<div id="highlight_content"><div class="content"><div class="para">x <a title="a > b" alt='>'>y</a> 1 < 2</div></div></div>"""
    rows = extract(spark, other_tags, grandchild, nested_blocks, quoted)
    assert rows[0]["paragraphs"] == ["a"]
    assert rows[1]["error_message"].startswith("Could not find judgment content")
    assert rows[2]["paragraphs"] == ["a b", "b"]
    assert rows[3]["paragraphs"] == ["x y 1 < 2"]
