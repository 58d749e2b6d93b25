import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gavelframe.llm.packing import pack

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Plain words, and more words.",
    None,
    "",
    " \n\t ",
    "it's  we'll x y 　 z",
    "Été 한 İstanbul ΟΔΟΣ ́lone 123 4a5 <|endoftext|>",
    "a" * 3000,
    "stop. stop, stop) ϓ́. ͅa İ, don't. (a 'S. ",
    "one two three " * 9000,
    "tail",
    "tail",
]
SCHEMA = "doc_id long, text string, ids string, part int"


def expected():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in TEXTS]


def test_round_trip(spark):
    rows = [(i if i != 8 else None, x, "k", 0) for i, x in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = pack(docs, PATH, window=256)
    got, want = out.collect(), expected()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == {i if i != 8 else None for i in range(len(TEXTS))}
    for i, ids in enumerate(want):
        pieces = sorted(by_doc[i if i != 8 else None], key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces]))[:-1]
        assert sum(r.length for r in pieces) == len(ids) == pieces[0].doc_tokens
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    total = sum(map(len, want))
    assert sorted(sequences) == list(range(-(-total // 256)))
    for k, pieces in sequences.items():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces]))[:-1]
        length = min(256, total - 256 * k)
        assert sum(r.length for r in pieces) == length
        assert {(r.sequence_length, r.padded_length) for r in pieces} == {(length, length if length & (length - 1) == 0 else 256)}


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0
