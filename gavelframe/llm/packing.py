"""Packing by concatenating and cutting.

All documents form one stream of token ids, each document closed by an end id,
and the stream is cut into windows of fixed length. Two passes find every
document's place without ordering the corpus:

1. each task encodes its documents once and notes how many ids it has put out
   before each of them; ids and local starts are written to a table;
2. the totals per task, one row each, give by a running sum the global start of
   every task. Adding it to the local start places a document, and the
   documents are cut where they lie: only a row per piece moves on.

Partitions keep the numbers under which they were written, so a lost executor
changes nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.llm.common import small_batches
from gavelframe.llm.tokens import encoder
from gavelframe.session import cut

_ROWS_AT_ONCE = 2000
_PIECES_AT_ONCE = 10_000


def _encoded(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), doc_tokens, part, local_start."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, words = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        for batch in batches:
            for k in range(0, len(batch), _ROWS_AT_ONCE):
                rows = batch.slice(k, _ROWS_AT_ONCE)
                ids, sizes = words.encode(rows.column("text"), end_id)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                buffers = [None, pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id"),
                        pa.Array.from_buffers(pa.binary(), len(rows), buffers),
                        pa.array(sizes),
                        pa.array(np.full(len(rows), part, np.int32)),
                        pa.array(start + bounds[:-1]),
                    ],
                    names=["id", "ids", "doc_tokens", "part", "local_start"],
                )
                start += int(bounds[-1])
            pa.default_memory_pool().release_unused()

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    return rows.mapInArrow(encode, f"id {kind}, ids binary, doc_tokens long, part int, local_start long")


def _pieces(window: int, kind: str):
    columns = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for doc, ids, n, place in zip(batch["id"], batch["ids"], batch["doc_tokens"], batch["place"], strict=True):
                view, start = memoryview(ids), 0
                while start < n:
                    sequence, offset = divmod(place + start, window)
                    length = min(window - offset, n - start)
                    crc = zlib.crc32(view[4 * start : 4 * (start + length)])
                    out.append((doc, start, length, crc, n, sequence, offset))
                    start += length
                    if len(out) == _PIECES_AT_ONCE:
                        yield _frame(out)
                        out = []
            if out:
                yield _frame(out)

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        return frame.astype({"id": "Int64"}) if kind in ("bigint", "int") else frame

    return cut_up, columns


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 2048,
    end_id: int = 1,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length, padded_length.

    Every document has at least its end id, so NULL and empty texts give a
    piece of one id. Only the last sequence can be shorter than `window`; it is
    padded to it, except if its length is a power of two. `tokenizer` is the
    path of the vocabulary file on every machine; it must drop white space.
    Repeated and NULL ids are packed as documents of their own. Other columns
    are not looked at; an empty table gives an empty result.
    """
    with small_batches(docs.sparkSession, _ROWS_AT_ONCE):
        ids = cut(_encoded(docs, id_col, text_col, tokenizer, end_id), "packing-ids")
    totals = ids.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    running = F.sum("total").over(Window.orderBy("part"))
    bases = totals.select(F.col("part").alias("of_part"), (running - F.col("total")).alias("base"), running.alias("all_tokens"))
    bases = cut(bases, "packing-bases")
    placed = ids.join(bases, F.col("part") == F.col("of_part")).select(
        "id", "ids", "doc_tokens", (F.col("base") + F.col("local_start")).alias("place")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    with small_batches(docs.sparkSession):  # written, as a batch of long documents is held several times over
        pieces = cut(placed.mapInPandas(*_pieces(window, kind)), "packing-pieces")
    total = bases.agg(F.max("all_tokens").alias("n")).head()["n"]
    length = F.least(F.lit(window), F.lit(total).cast("long") - F.col("sequence_id") * window)
    padded = F.when(F.bit_count("sequence_length") == 1, F.col("sequence_length")).otherwise(F.lit(window))
    return (
        pieces.withColumn("sequence_length", length.cast("long"))
        .withColumn("padded_length", padded.cast("long"))
        .withColumnRenamed("id", id_col)
    )
