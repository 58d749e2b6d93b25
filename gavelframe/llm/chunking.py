"""Repeated passages by content-defined chunking.

A gear hash rolls over the last 16 bytes of each text; where its upper bits fall
below a threshold, a chunk may end. Ends depend on nearby bytes only, so text
inserted elsewhere moves no chunk of a shared passage. Consecutive chunks that
together reach `min_bytes` form a group, known by a 64-bit digest over those of
its chunks, and its bytes. There is a shortest group from each chunk on and a shortest
one up to each chunk; together they cover every chunk of a shared row of chunks
that is long enough. A group found in more than one document is a passage that
one other document holds as a whole; overlapping or adjoining ones form a run.

Texts stay where they are: groups are written as narrow rows, one aggregate
finds the repeated digests (a hot one is combined within each task first), and
the join back moves digests and places only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.session import cut

_WINDOW = 16
_SLICE_BYTES = 1 << 21
_ROW_BITS = 33


def _gear_table() -> np.ndarray:
    """256 well-mixed 32-bit values by a multiplicative rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear_table()


def chunk_ends(data: np.ndarray, starts: np.ndarray, mean: int, gap: int, longest: int) -> np.ndarray:
    """Ends (exclusive) of the chunks of documents that lie one after another in `data`.

    An end needs a low hash, no other low hash within the `gap` bytes before
    it, and no continuation byte of UTF-8 behind it. Without one for `longest`
    bytes, the text is cut there (at most 3 bytes earlier, between characters).
    """
    n = len(data)
    if n == 0:
        return np.empty(0, np.int64)
    h, width = _GEAR[data], 1
    while width < _WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    low = (h >> np.uint32(16)) < np.uint32((1 << 16) // mean)
    low[:-1] &= (data[1:] & 0xC0) != 0x80
    raw = np.flatnonzero(low)
    # A hash near the start of a document has seen the one before it.
    own_start = starts[np.searchsorted(starts, raw, side="right") - 1]
    raw = raw[raw - own_start >= _WINDOW - 1]
    raw = raw[np.diff(raw, prepend=-gap - 1) > gap] + 1
    ends = np.union1d(np.union1d(raw, starts[1:]), [n])
    ends = ends[ends > 0]
    before = np.concatenate([[0], ends[:-1]])
    more = []
    for a, b in zip(before[ends - before > longest], ends[ends - before > longest], strict=True):
        while b - a > longest:
            a += longest
            while (data[a] & 0xC0) == 0x80:
                a -= 1
            more.append(a)
    return np.union1d(ends, np.array(more, np.int64)) if more else ends


def _grouper(min_bytes: int, mean: int, gap: int, longest: int):
    def slices(ids: list, texts: list[bytes]) -> Iterator[tuple[list, list[bytes]]]:
        a, size = 0, 0
        for b, text in enumerate(texts):
            size += len(text)
            if size >= _SLICE_BYTES:
                yield ids[a : b + 1], texts[a : b + 1]
                a, size = b + 1, 0
        yield ids[a:], texts[a:]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = TaskContext.get().partitionId() << _ROW_BITS
        for batch in batches:
            texts = [text.encode("utf-8", "surrogatepass") for text in batch["text"]]
            for ids, part in slices(list(batch["id"]), texts):
                joined = b"".join(part)
                sizes = np.array([len(x) for x in part], np.int64)
                first_row, row = row, row + len(part)
                if not joined:
                    continue
                full = sizes > 0
                starts = (np.cumsum(sizes) - sizes)[full]
                ends = chunk_ends(np.frombuffer(joined, np.uint8), starts, mean, gap, longest)
                begins = np.concatenate([[0], ends[:-1]])
                owner = np.searchsorted(starts, begins, side="right") - 1
                first, last = _groups(begins, ends, owner, min_bytes)
                own = np.fromiter(
                    (xxhash.xxh64_intdigest(joined[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)), np.uint64, len(ends)
                ).tobytes()
                spans = zip((8 * first).tolist(), (8 * last + 8).tolist(), strict=True)
                digest = np.fromiter((xxhash.xxh64_intdigest(own[a:b]) for a, b in spans), np.uint64, len(first))
                owner = owner[first]
                number = np.flatnonzero(full)[owner]
                lead = np.searchsorted(begins, starts)[owner]
                yield pd.DataFrame(
                    {
                        "id": pd.Series(ids, dtype=batch["id"].dtype).take(number).to_numpy(),
                        "row": first_row + number,
                        "first": (first - lead).astype(np.int32),
                        "last": (last - lead).astype(np.int32),
                        "start": begins[first] - starts[owner],
                        "length": ends[last] - begins[first],
                        "digest": digest.view(np.int64),
                    }
                )

    return run


def _groups(begins: np.ndarray, ends: np.ndarray, owner: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last chunk of each group: the shortest from each chunk on and up to each chunk, within one document."""
    n = len(ends)
    each = np.arange(n)
    last = np.searchsorted(ends, begins + min_bytes)
    first = np.searchsorted(begins, ends - min_bytes, side="right") - 1
    pairs = np.concatenate([np.stack([each, last]), np.stack([first, each])], axis=1)
    pairs = pairs[:, (pairs[0] >= 0) & (pairs[1] < n)]
    pairs = pairs[:, owner[pairs[0]] == owner[pairs[1]]]
    return np.divmod(np.unique(pairs[0] * n + pairs[1]), n)


def groups(
    docs: DataFrame, id_col: str, text_col: str, min_bytes: int, mean: int = 20, gap: int = 8, longest: int = 1024
) -> DataFrame:
    """One row per group: id, row (a number of the input row), first and last chunk, start and length in bytes, digest."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(
        _grouper(min_bytes, mean, gap, longest), f"id {kind}, row long, first int, last int, start long, length long, digest long"
    )


def repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 128, **chunking: int
) -> DataFrame:
    """One row per run of chunks in passages of at least `min_bytes` that another row of the table also holds.

    Columns: id, start_byte, n_bytes, n_chunks, first_id (smallest id among the
    holders of its passages), repeat_bytes (bytes whose first holder has another
    id: what removing repeats takes away). Documents without such a run give no
    row; NULL and empty texts have none. Repetition within one row is not
    counted. Rows with equal or NULL ids are separate documents; a NULL id
    comes after all others as holder. Other columns are not looked at.
    """
    found = cut(groups(docs, id_col, text_col, min_bytes, **chunking), "chunk-groups")
    held = found.groupBy("digest", "length").agg(
        F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.min("id").alias("first_id")
    )
    # Written, so that the join deals both sides anew and can split a hot digest.
    repeated = cut(held.where("first_row < last_row").select("digest", "length", "first_id"), "repeated-groups")
    stop = F.col("start") + F.col("length")
    other = ~F.col("id").eqNullSafe(F.col("first_id"))
    marked = found.join(repeated, ["digest", "length"]).select(
        "id", "row", "first", "last", "start", stop.alias("stop"), "first_id", F.when(other, stop).alias("other_stop")
    )
    in_order = Window.partitionBy("row").orderBy("first", "last")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # A group that starts behind all before it, and not right behind them, opens a run.
    opens = F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True))
    seen = F.greatest("start", F.coalesce(F.max("other_stop").over(before), F.lit(0)))
    again = F.greatest(F.coalesce(F.col("other_stop") - seen, F.lit(0)), F.lit(0))
    steps = marked.withColumns({"opens": opens.cast("int"), "again": again})
    islands = steps.withColumn("island", F.sum("opens").over(in_order))
    runs = islands.groupBy("row", "island").agg(
        F.first("id").alias(id_col),
        F.min("start").alias("start_byte"),
        (F.max("stop") - F.min("start")).alias("n_bytes"),
        (F.max("last") - F.min("first") + 1).cast("long").alias("n_chunks"),
        F.min("first_id").alias("first_id"),
        F.sum("again").alias("repeat_bytes"),
    )
    return runs.drop("row", "island")
