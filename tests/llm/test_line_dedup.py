from collections import defaultdict

from gavelframe.llm.line_dedup import remove_spread_lines

SCHEMA = "doc_id long, text string, source string, n_removed string"


def brute(rows, min_sites):
    sites = defaultdict(set)
    for _, text, source, _ in rows:
        for line in (text or "").split("\n"):
            if line.strip(" \t\r"):
                sites[line.strip(" \t\r")].add(source)
    spread = {line for line, s in sites.items() if len(s) >= min_sites}
    out = []
    for doc_id, text, _, _ in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if x.strip(" \t\r") not in spread]
        out.append((doc_id, sum(bool(x.strip(" \t\r")) for x in lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def corpus():
    rows = []
    for i in range(60):
        site = [None, "NULL", "=a"][i % 3] if i < 6 else f"s{i % 17}"
        text = [f"own {i}", "", "  everywhere\r", "everywhere" if i % 2 else "even", "same site"]
        if i % 17 < 5:
            text.append("five sites")
        rows.append((i, "\n".join(text), site, None))
    rows += [(90, None, "x", None), (91, "", "x", None), (92, "\n\n", "y", None), (93, "everywhere", "y", None)]
    rows += [(None, "everywhere\nlone", "s1", None), (7, "even\nrest", "s2", "k"), (7, "even\nrest", "s2", "k")]
    rows.append((94, "everywhere\n" * 20_000 + "x" * 100_000, "z", None))
    return rows


def test_matches_brute_force_at_several_thresholds(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for min_sites in (1, 2, 5, 19):
        got = remove_spread_lines(docs, min_sites=min_sites)
        found = sorted((tuple(r) for r in got.select("row.doc_id", "n_lines", "n_removed", "clean_text").collect()), key=str)
        assert found == brute(rows, min_sites)


def test_coarse_sketches_still_decide_exactly_near_the_threshold(spark):
    rows = [(i, f"many\nfew{i % 7}", f"s{i}", None) for i in range(700)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = remove_spread_lines(docs, min_sites=100, lg_k=6).selectExpr("sum(n_removed) AS n").head()["n"]
    assert got == 1400
    got = remove_spread_lines(docs, min_sites=101, lg_k=6).selectExpr("sum(n_removed) AS n").head()["n"]
    assert got == 700


def test_empty_table(spark):
    assert remove_spread_lines(spark.createDataFrame([], SCHEMA)).count() == 0
