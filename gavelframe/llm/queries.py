"""Registered queries of the corpus operators and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelframe.llm import licences
from gavelframe.llm.chunking import repeated_runs
from gavelframe.llm.collocations import collocations
from gavelframe.llm.common import ascii_lower, table
from gavelframe.llm.context_mixing import score_texts
from gavelframe.llm.cotraining import classify
from gavelframe.llm.exact_dedup import exact_dedup
from gavelframe.llm.line_dedup import remove_spread_lines
from gavelframe.llm.merkle import manifest
from gavelframe.llm.minhash import near_duplicates
from gavelframe.llm.mixing import mix
from gavelframe.llm.packing import pack
from gavelframe.llm.sharding import assign
from gavelframe.llm.vptree import nearest

# DuckDB: text with only A-Z lower-cased.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("key")


OP1_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) BETWEEN 1 AND 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM e AS a JOIN e AS b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE common >= 0.8::DOUBLE * (na + nb - common) - 1e-9),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT doc_id, min(other) AS class_id, count(*) AS class_size FROM r GROUP BY doc_id)
SELECT doc_id, class_id, class_size, doc_id = class_id AS kept FROM c
"""


def op2_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("row.doc_id", "text_score", "metadata_score", "score", "kept")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP3_SQL = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op5_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP5_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_reduce(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]), lambda x, y: x + y) AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def word_tokenizer() -> str:
    """Vocabulary file of the packing query, as the machines' tokenizer folder names it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_concat_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op7_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op8_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         (('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, sum(size * length(bin(size)))::DOUBLE / sum(size)::DOUBLE AS tilt, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
w AS (SELECT *, ((k - 1) % 3 + 1)::DOUBLE AS weight, 3.0::DOUBLE * source_size AS most, sum(source_size) OVER () AS total FROM s),
c AS (
  SELECT *, most <= (total - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * weight AS capped
  FROM w WINDOW o AS (ORDER BY most / weight, source NULLS LAST)),
t AS (
  SELECT *, CASE WHEN capped THEN most ELSE (total - sum(CASE WHEN capped THEN most ELSE 0 END) OVER ())
    / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () * weight END AS target
  FROM c),
r AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS whole FROM t),
q AS (SELECT *, CASE WHEN whole >= 3 THEN 0 ELSE greatest(round(target)::BIGINT - whole * source_size, 0) END AS rest FROM r),
j AS (
  SELECT d.doc_id, d.size, q.*, u / (1 - u) * ((1 - p) / p) AS odds
  FROM q JOIN (
    SELECT d.*, least(greatest(rest / source_size * length(bin(size)) / tilt, 1e-9), 1 - 1e-9) AS p
    FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source) d ON d.source IS NOT DISTINCT FROM q.source),
f AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds) - size AS start FROM j)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, rest - start)))::BIGINT AS taken,
       (whole + CASE WHEN start + size < rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM f
"""

def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_runs(table(spark, sf_dir, "documents"))


def op10_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_spread_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "row.doc_id", "n_lines", "n_removed", F.length("clean_text").cast("long").alias("clean_chars"),
        F.sha2("clean_text", 256).alias("clean_sha256"),
    )


OP10_SQL = """
WITH d AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, coalesce('=' || source, 'NULL') AS site, unnest(lines) AS line, generate_subscripts(lines, 1) AS k FROM d),
t AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS body FROM l),
s AS (SELECT body FROM t WHERE body <> '' GROUP BY body HAVING count(DISTINCT site) >= 10),
m AS (SELECT t.*, s.body IS NOT NULL AS gone FROM t LEFT JOIN s ON t.body = s.body),
c AS (
  SELECT doc_id, count(*) FILTER (body <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '') AS clean_text
  FROM m GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, length(clean_text) AS clean_chars, sha256(clean_text) AS clean_sha256 FROM c
"""


def op11_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    laws = {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    return assign(table(spark, sf_dir, "documents")).withColumns(laws)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("text").isNotNull(), ascii_lower(F.col("text")))
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = manifest(table(spark, sf_dir, "documents"), tampered={"text": text}, where=chosen)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _sealed_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in fields) + ")"


# Bits of the check sum, eight steps per digit: the digit, then seven times nothing.
_CRC_SQL = """xor(4294967295, list_reduce(
    flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(xor(c, b) >> 1, 3988292384) ELSE xor(c, b) >> 1 END,
    4294967295::BIGINT))"""

OP12_SQL = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_sealed_sql("text")} AS leaf,
         CASE WHEN {_CRC_SQL} % 5 = 0 THEN {_sealed_sql(f"CASE WHEN text IS NOT NULL THEN {_LOWER} END")} END AS forged
  FROM documents),
p AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n FROM l),
up AS (
  SELECT tree, 0 AS height, pos, leaf AS digest, n FROM p
  UNION ALL
  SELECT tree, height + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16
  FROM up WHERE n > 1 GROUP BY tree, height, pos // 16, n),
s AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
crown AS (
  SELECT 0 AS height, pos, subroot AS digest, n FROM s
  UNION ALL
  SELECT height + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16
  FROM crown WHERE n > 1 GROUP BY height, pos // 16, n),
f AS (
  SELECT tree, pos AS place, 0 AS height, pos, coalesce(forged, leaf) AS digest, '' AS proof, n FROM p
  UNION ALL
  SELECT f.tree, f.place, f.height + 1, f.pos // 16,
         sha256(string_agg(CASE WHEN u.pos = f.pos THEN f.digest ELSE u.digest END, '' ORDER BY u.pos)),
         f.proof || coalesce(string_agg(u.digest, '' ORDER BY u.pos) FILTER (u.pos <> f.pos), ''), (f.n + 15) // 16
  FROM f JOIN up AS u ON u.tree = f.tree AND u.height = f.height AND u.pos // 16 = f.pos // 16
  WHERE f.n > 1 GROUP BY f.tree, f.place, f.height, f.pos, f.proof, f.n),
g AS (
  SELECT f.tree, f.place, 0 AS height, s.pos, f.digest, f.proof, s.n FROM f JOIN s ON f.tree = s.tree WHERE f.n = 1
  UNION ALL
  SELECT g.tree, g.place, g.height + 1, g.pos // 16,
         sha256(string_agg(CASE WHEN u.pos = g.pos THEN g.digest ELSE u.digest END, '' ORDER BY u.pos)),
         g.proof || coalesce(string_agg(u.digest, '' ORDER BY u.pos) FILTER (u.pos <> g.pos), ''), (g.n + 15) // 16
  FROM g JOIN crown AS u ON u.height = g.height AND u.pos // 16 = g.pos // 16
  WHERE g.n > 1 GROUP BY g.tree, g.place, g.height, g.pos, g.proof, g.n),
root AS (SELECT digest AS root FROM crown WHERE n = 1)
SELECT p.doc_id, p.leaf, s.subroot, root.root, sha256(g.proof) AS proof_sha256, g.digest AS folded_root, g.digest = root.root AS verified
FROM p JOIN s ON s.tree = p.tree JOIN g ON g.tree = p.tree AND g.place = p.pos AND g.n = 1 CROSS JOIN root
"""


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM pieces),
t AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, m, unnest(list_transform(range(1, len(words) - m + 2), lambda i: array_to_string(words[i:i + m - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(words) >= m),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY lang, m, phrase HAVING count(*) >= 30),
q AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS words, unnest(range(1, m)) AS k FROM f WHERE m > 1),
h AS (SELECT lang, m, phrase, a, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:], ' ') AS tail FROM q),
c AS (
  SELECT h.lang, h.m, h.phrase, h.a, h.k, x.a AS l, y.a AS r, ((2000000::HUGEINT * h.a) // (x.a + y.a))::BIGINT AS score
  FROM h JOIN f AS x ON x.lang = h.lang AND x.phrase = h.head JOIN f AS y ON y.lang = h.lang AND y.phrase = h.tail),
s AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (
  SELECT lang, a, unnest(CASE m WHEN 3 THEN [words[1:2], words[2:3]]
    ELSE [words[1:2], words[2:3], words[3:4], words[1:3], words[2:4]] END) AS part
  FROM (SELECT lang, m, a, string_split(phrase, ' ') AS words FROM f WHERE m > 2)),
b AS (SELECT lang, array_to_string(part, ' ') AS phrase, max(a) AS most FROM o GROUP BY 1, 2),
alive AS (
  SELECT s.* FROM s LEFT JOIN b ON b.lang = s.lang AND b.phrase = s.phrase WHERE b.most IS NULL OR 100 * b.most < 80 * s.a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alive)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM r JOIN t ON t.lang = r.lang WHERE r.rank <= 2000
"""

QUERIES = {
    "op1_dart_minhash": op1_dart_minhash,
    "op2_cotraining": op2_cotraining,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_licence_scan": op4_licence_scan,
    "op5_vantage_trees": op5_vantage_trees,
    "op6_concat_packing": op6_concat_packing,
    "op7_context_mixing": op7_context_mixing,
    "op8_pareto_mixing": op8_pareto_mixing,
    "op9_chunk_dedup": op9_chunk_dedup,
    "op10_line_spread": op10_line_spread,
    "op11_best_fit_shards": op11_best_fit_shards,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_phrase_collocations": op13_phrase_collocations,
}
ORACLES = {
    "op1_dart_minhash": OP1_SQL,
    "op3_exact_dedup": OP3_SQL,
    "op4_licence_scan": licences.oracle(lower=_LOWER),
    "op5_vantage_trees": OP5_SQL,
    "op8_pareto_mixing": OP8_SQL,
    "op10_line_spread": OP10_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_phrase_collocations": OP13_SQL,
}
