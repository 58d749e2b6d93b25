from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from gavelframe.llm.mixing import mix
from tests.llm.test_minhash import brute as near_classes

DATA = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Output of every stage on the smallest tables, each written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    out.append(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(folder / str(k)))
        docs = spark.read.parquet(str(folder / str(k)))
        out.append(docs)
    return out


def test_stages_before_the_last_return_documents(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns


def test_quality_follows_the_labels(spark, stages):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    kept = stages[1].select("doc_id").withColumn("kept", F.lit(True))
    judged = labels.join(stages[0].select("doc_id"), "doc_id").join(kept, "doc_id", "left").collect()
    right = sum((r.kept is True) == (r.quality == 1) for r in judged)
    assert right / len(judged) > 0.93


def test_exact_keeps_the_largest_id_of_each_text(stages):
    best = {}
    for r in stages[1].select("doc_id", "text").collect():
        best[lowered(r.text)] = max(best.get(lowered(r.text), -1), r.doc_id)
    assert sorted(best.values()) == sorted(r.doc_id for r in stages[2].select("doc_id").collect())


def test_near_keeps_one_of_each_class(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].select("doc_id", "text").collect()]
    classes = {class_id for _, class_id, _ in near_classes(rows)}
    assert sorted(classes) == sorted(r.doc_id for r in stages[3].select("doc_id").collect())


def test_mixing_takes_what_the_targets_say(stages):
    taken = Counter()
    for r in mix(stages[3], whole_texts=True).collect():
        taken[r.doc_id] += r.taken
    words = Counter()
    for r in stages[4].select("doc_id", "text").collect():
        words[r.doc_id] += len((r.text or "").split())
    assert +taken == +words


def test_packing_loses_no_token(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter()
    for r in stages[4].select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        want[(r.doc_id, len(ids))] += len(ids)
    got, filled = Counter(), Counter()
    for r in stages[5].collect():
        got[(r.doc_id, r.doc_tokens)] += r.length
        filled[r.sequence_id] += r.length
    assert got == want
    assert all(n == 2048 for k, n in filled.items() if k < max(filled))


def test_empty_documents(spark, stages):
    docs = spark.createDataFrame([], stages[0].schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        assert docs.count() == 0


@pytest.fixture(scope="module")
def odd(spark, stages):
    """Documents with NULLs, empty and very long texts, repeated rows, equal texts, and columns named like inner ones."""
    schema = stages[0].schema
    for name in ("row", "key", "score", "copies", "affinity", "id", "kept"):
        schema = T.StructType([*schema.fields, T.StructField(name, T.StringType())])
    values = {"source": "src1", "lang": "en", "n_chars": 10}
    texts = ["plain words of a short text in a row", "Plain words of a short text in a row", "", None, "long words go on " * 30_000, " \n\t "]
    rows = [{"doc_id": i, "text": text, **values} for i, text in enumerate(texts)]
    rows += [rows[0], rows[3], {"doc_id": None, "text": "no id here at all", **values}, {"doc_id": 20, "text": texts[0]}, {"doc_id": 21}, {}, {}]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def test_quality_of_odd_documents(spark, odd):
    out = corpus_pipeline.quality(spark, odd, DATA)
    assert out.columns == odd.columns
    name = lambda df: Counter(str(r) for r in df.collect())
    kept, given = name(out), name(odd)
    assert all(given[r] == n for r, n in kept.items())  # as they were, and repeated rows alike


def test_exact_of_odd_documents(spark, odd):
    out = corpus_pipeline.exact(spark, odd, DATA)
    assert out.columns == odd.columns
    got = sorted(((r.doc_id, lowered(r.text)) for r in out.collect()), key=str)
    best = {}
    for r in odd.collect():
        best[lowered(r.text)] = max(best.get(lowered(r.text), -1), -1 if r.doc_id is None else r.doc_id)
    assert got == sorted(((None if i < 0 else i, text) for text, i in best.items()), key=str)


def test_near_of_odd_documents(spark, odd):
    out = corpus_pipeline.near(spark, odd, DATA)
    assert out.columns == odd.columns
    got = Counter(" ".join(lowered(r.text).split()) for r in out.collect())
    assert set(got) == {" ".join(lowered(r.text).split()) for r in odd.collect()}
    assert got["plain words of a short text in a row"] == 1


def test_mixing_of_odd_documents(spark, odd):
    out = corpus_pipeline.mix(spark, odd, DATA)
    assert out.columns == odd.columns
    got, given = Counter(str(r) for r in out.collect()), Counter(str(r) for r in odd.collect())
    assert all(n <= 3 * given[r] for r, n in got.items())


def test_packing_of_odd_documents(spark, odd):
    pieces = corpus_pipeline.packing(spark, odd, DATA).collect()
    starts = sum(r.start == 0 for r in pieces)
    assert starts == odd.count()
    whole = Counter()
    for r in pieces:
        whole[r.doc_id, r.doc_tokens] += r.length
    assert all(n % tokens == 0 for (_, tokens), n in whole.items())
    assert whole[21, 1] == 1
