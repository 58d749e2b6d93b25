"""Text probability by logistic context mixing, and a unigram baseline.

The model predicts the bits of each byte from the bytes before it. For each of
several context lengths, the exact counts of either bit after a context give an
estimate; these are mixed in the logistic domain by weights that are chosen by
bit position and by how many contexts are known (the gate), and the result is
refined by an adaptive probability map over the last byte.

A byte's probability depends on a window of few bytes, and the counts of all
distinct windows hold those of all contexts. Tasks cut their texts into units
and write each unit's distinct windows, dealt into shards by the last three
bytes before the predicted one. A shard thus holds every window of its longer
contexts, and their number grows with the input; the contexts of one and two
bytes have at most 2^24 windows, and are broadcast. Every distinct window is
evaluated once, in its shard, and each unit gets the values of its own back.

Weights and map learn online from all learnt windows, each with one occurrence
taken out of its own count. Each task takes its shards in turn; what the tasks
have learnt is averaged by the windows each cell has met, for a few rounds.

The baseline needs the count of every token. Tokens that make up at least one
part in `heavy_parts` of all are at most that many, and are broadcast; the rest
meet their counts by a join on the token, in which no key is large.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelframe.llm.common import ascii_lower
from gavelframe.llm.shingles import mix
from gavelframe.session import bounded_batches, cut, passing_cuts, passing_shuffles

ORDERS = (1, 2, 3, 4, 5)
_BITS = (16, 18, 20, 21, 21)  # log2 of the table sizes
_SIZES = tuple(1 << b for b in _BITS)
_STARTS = tuple(int(x) for x in np.cumsum((0, *_SIZES[:-1])))
_SLOTS = sum(_SIZES)
_CHUNK = 4096
_MOST = 2**31 - 1  # counters stay there
_END_BYTE = 0xFF  # never part of UTF-8: ends a text, and stands before its first byte
_SLICE_BYTES = 1_500_000
_MERGE_AT = 2_500_000
_UNIT_BYTES = 16_000_000
_LOW = 2  # contexts up to here are broadcast, the others lie in shards
_SHARDS = (64, 4096)
_ROUNDS = 3
_DOCS = 1 << 20  # stands for the shard of a text, behind all others
_ROW_BITS = 33
_END_TOKEN = "\n"  # no token holds white space
_APM = np.linspace(-8, 8, 33)
_ORDER_STEP, _NODE_STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One window per byte and end of each text (context bytes above the byte itself), and the bounds of each text."""
    pad = max(ORDERS)
    data = texts.cast(pa.binary()).to_pylist()
    lead, tail = bytes([_END_BYTE]) * pad, bytes([_END_BYTE])
    joined = np.frombuffer(b"".join(part for x in data for part in (lead, x, tail)), np.uint8)
    sizes = np.array([len(x) + 1 for x in data], np.int64)
    key = joined.astype(np.uint64)
    for j in range(1, pad + 1):
        key[j:] |= np.left_shift(joined[:-j], np.uint64(8 * j), dtype=np.uint64)
    real = np.ones(len(joined), bool)
    starts = np.cumsum(sizes + pad) - sizes - pad
    for j in range(pad):
        real[starts + j] = False
    return key[real], np.concatenate([[0], np.cumsum(sizes)])


def _slices(texts: pa.Array, most: int = _SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(texts):
        before = sizes[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(sizes, before + most)))
        yield a, texts.slice(a, b - a)
        a = b


def slots(window: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """Table slots (orders x windows) for the `bit`-th bit from the top, and the bit itself."""
    byte = window & np.uint64(0xFF)
    node = (byte | np.uint64(0x100)) >> np.uint64(8 - bit)
    out = np.empty((len(ORDERS), len(window)), np.int64)
    for k, order in enumerate(ORDERS):
        context = (window >> np.uint64(8)) & np.uint64((1 << (8 * order)) - 1)
        if order == 1:
            out[k] = (context << np.uint64(8)) | node
        else:
            h = mix(context * _ORDER_STEP + node * _NODE_STEP + np.uint64(order))
            out[k] = (h >> np.uint64(64 - _BITS[k])).astype(np.int64) + _STARTS[k]
    return out, ((byte >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)


def _packed(values: np.ndarray) -> bytes:
    """Bytes of equal rank lie together, so that small values shrink."""
    return pa.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(data, size * width, "zstd", asbytes=True)
    return np.frombuffer(np.frombuffer(raw, np.uint8).reshape(width, -1).T.tobytes(), kind)


def _packed_windows(window: np.ndarray) -> bytes:
    return _packed(np.diff(window, prepend=np.uint64(0)))


def _unpacked_windows(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(_unpacked(data, size, np.uint64), dtype=np.uint64)


def _summed(windows_and_counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct windows and the sums of their counts. Sorted parts are merged."""
    window = np.concatenate([w for w, _ in windows_and_counts])
    order = np.argsort(window, kind="stable")
    window = window[order]
    first = np.flatnonzero(np.diff(window, prepend=~window[:1]))
    return window[first], np.add.reduceat(np.concatenate([n for _, n in windows_and_counts])[order], first)


def _distinct(window: np.ndarray, learnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct windows and how often each is learnt. The flag is the lowest bit, so values are sorted, not places."""
    flagged = np.sort(window << np.uint64(1) | learnt)
    window = flagged >> np.uint64(1)
    first = np.flatnonzero(np.diff(window, prepend=~window[:1]))
    return window[first], np.add.reduceat((flagged & np.uint64(1)).astype(np.int64), first)


def _units(shards: int, kind: str):
    """Rows of the texts, and one row per unit and shard with the unit's distinct windows and how often they are learnt."""
    names = ["unit", "shard", "row", "id", "learn", "text", "size", "w", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = row = TaskContext.get().partitionId() << _ROW_BITS
        held, fresh, seen = [], 0, 0

        def closed(id_type: pa.DataType) -> pa.RecordBatch:
            window, n = _summed(held)
            shard = (mix((window >> np.uint64(8)) & np.uint64(0xFFFFFF)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard.astype(np.uint16), kind="stable")
            window, n = window[order], n[order]
            used, first = np.unique(shard[order], return_index=True)
            bounds = list(zip(first.tolist(), [*first[1:].tolist(), len(window)], strict=True))
            k = len(used)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(k, unit)), pa.array(used.astype(np.int32)), pa.array(np.zeros(k, np.int64)), pa.nulls(k, id_type),
                    pa.nulls(k, pa.bool_()), pa.nulls(k, pa.string()), pa.array([b - a for a, b in bounds], pa.int32()),
                    pa.array([_packed_windows(window[a:b]) for a, b in bounds], pa.binary()), pa.array([_packed(n[a:b]) for a, b in bounds], pa.binary()),
                ],
                names=names,
            )

        id_type = None
        for batch in batches:
            id_type = batch.column("id").type
            for a, part in _slices(batch.column("text")):
                k, learn = len(part), batch.column("learn").slice(a, len(part))
                key, bounds = windows(part)
                learnt = np.repeat(learn.to_numpy(zero_copy_only=False).astype(bool), np.diff(bounds))
                held.append(_distinct(key, learnt))
                fresh, seen = fresh + len(held[-1][0]), seen + len(key)
                del key, learnt
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(k, unit)), pa.array(np.full(k, _DOCS, np.int32)), pa.array(row + np.arange(k)), batch.column("id").slice(a, k),
                        learn, part.cast(pa.string()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()),
                    ],
                    names=names,
                )
                row += k
                if seen >= _UNIT_BYTES:
                    yield closed(id_type)
                    unit, held, fresh, seen = unit + 1, [], 0, 0
                elif fresh > _MERGE_AT:
                    held, fresh = [_summed(held)], 0
        if held:
            yield closed(id_type)

    return run, f"unit long, shard int, row long, id {kind}, learn boolean, text string, size int, w binary, n binary"


def count_windows(units: DataFrame) -> DataFrame:
    """shard, size, w, n: all distinct windows of a shard and how often each is learnt."""

    def add_up(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [(_unpacked_windows(r.w, r.size_), _unpacked(r.n, r.size_, np.int64)) for r in frame.itertuples()]
        window, n = _summed(parts)
        return pd.DataFrame({"shard": frame["shard"].iloc[:1], "salt": frame["salt"].iloc[:1], "size_": [len(window)], "w": [_packed_windows(window)], "n": [_packed(n)]})

    kind = "shard int, salt long, size_ int, w binary, n binary"
    parts = units.select("shard", F.expr(f"shiftright(unit, {_ROW_BITS + 8})").alias("salt"), F.col("size").alias("size_"), "w", "n")
    whole = parts.groupBy("shard", "salt").applyInPandas(add_up, kind).groupBy("shard").applyInPandas(add_up, kind)
    return cut(whole.select("shard", F.col("size_").alias("size"), "w", "n"), "lm-windows")


def _low_windows(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the short contexts and their counts; at most 2^24 whatever the input."""

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, w, n in zip(*(batch.column(c).to_pylist() for c in ("size", "w", "n")), strict=True):
                window, n = _summed([(_unpacked_windows(w, size) & np.uint64((1 << 8 * (_LOW + 1)) - 1), _unpacked(n, size, np.int64))])
                yield pa.RecordBatch.from_arrays([pa.array(window.astype(np.int64)), pa.array(n)], names=["w", "n"])

    low = counted.mapInArrow(shorten, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).where("n > 0").toPandas()
    return low["w"].to_numpy(np.int64).astype(np.uint64), low["n"].to_numpy(np.int64)


class Counts:
    """Exact counts of either bit after the contexts of some lengths, from windows and their counts."""

    def __init__(self, window: np.ndarray, n: np.ndarray, orders: tuple[int, ...]) -> None:
        self._tables = {}
        for order in orders:
            own = window & np.uint64((1 << (8 * order + 8)) - 1)
            by = np.argsort(own)
            own, times = own[by], n[by]
            for bit in range(8):  # one order of the windows is that of the keys of every bit
                key, value = self._key(own, order, bit)
                first = np.diff(key, prepend=~key[:1]) != 0
                keys, codes = key[first], np.cumsum(first) - 1
                self._tables[order, bit] = keys, np.bincount(2 * codes + value, times, 2 * len(keys)).reshape(-1, 2)

    @staticmethod
    def _key(window: np.ndarray, order: int, bit: int) -> tuple[np.ndarray, np.ndarray]:
        byte = window & np.uint64(0xFF)
        context = (window >> np.uint64(8)) & np.uint64((1 << (8 * order)) - 1)
        node = (byte | np.uint64(0x100)) >> np.uint64(8 - bit)
        return (context << np.uint64(9)) | node, ((byte >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)

    def seen(self, window: np.ndarray, bit: int) -> np.ndarray:
        """(orders x windows x 2)"""
        out = []
        for (order, own_bit), (keys, n) in self._tables.items():
            if own_bit == bit:
                key = self._key(window, order, bit)[0]
                at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
                hit = keys[at] == key if len(keys) else np.zeros(len(key), bool)
                out.append(np.where(hit[:, None], n[at] if len(keys) else 0.0, 0.0))
        return np.array(out)


def _stretch(n: np.ndarray) -> np.ndarray:
    """Log odds of bit 1 from the counts of either bit in the last axis; 0 if there are none."""
    return np.log((n[..., 1] + 0.4) / (n[..., 0] + 0.4))


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


Look = Callable[[np.ndarray, int], np.ndarray]


@dataclass
class Mixer:
    """Weights per bit position and number of known contexts, and the map that refines the mixed value per last byte."""

    weights: np.ndarray
    refined: np.ndarray

    @classmethod
    def fresh(cls) -> Mixer:
        weights = np.full((8, len(ORDERS) + 1, len(ORDERS)), 0.3)
        return cls(weights, np.tile(_squash(_APM), (256, 1)))

    def mixed(self, bit: int, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return (self.weights[bit][gate].T * inputs).sum(0)

    def final(self, window: np.ndarray, mixed: np.ndarray) -> tuple[np.ndarray, ...]:
        """Refined probability of bit 1, and the two cells of the map with the share of the upper one."""
        at = np.clip((mixed + 8) * 2, 0, 31.999)
        low = at.astype(np.int64)
        share, last = at - low, ((window >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)
        refined = self.refined[last, low] * (1 - share) + self.refined[last, low + 1] * share
        return np.clip((_squash(mixed) + refined) / 2, 1e-6, 1 - 1e-6), last, low, share

    def learn(self, table: np.ndarray, window: np.ndarray, count: np.ndarray, batch: int = 1024, epochs: int = 3) -> None:
        """Online steps with a table of hashed slots."""
        look = lambda own, bit: table[slots(own, bit)[0]]
        for epoch in range(epochs):
            self.steps(look, window, count, 0.05 / (1 + epoch), batch)

    def steps(self, look: Look, window: np.ndarray, count: np.ndarray, rate: float, batch: int = 1024, met: Mixer | None = None) -> None:
        """Online steps over the windows in the given order; each is predicted from the counts of all others.

        `met` adds up how many occurrences each weight row and cell of the map has met.
        """
        for a in range(0, len(window), batch):
            own, n = window[a : a + batch], count[a : a + batch].astype(float)
            times, n = n, n / n.sum()
            for bit in range(8):
                value = ((own >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)
                seen = look(own, bit).astype(float)
                mine = (np.arange(len(ORDERS))[:, None], np.arange(len(own))[None, :], value[None, :])
                seen[mine] = np.maximum(seen[mine] - 1, 0)
                inputs, gate = np.clip(_stretch(seen), -8, 8), (seen.sum(2) > 0).sum(0)
                mixed = self.mixed(bit, inputs, gate)
                error = (value - _squash(mixed)) * n
                np.add.at(self.weights[bit], gate, rate * len(own) / 16 * (error * inputs).T)
                _, last, low, share = self.final(own, mixed)
                for cell, part in ((low, 1 - share), (low + 1, share)):
                    np.add.at(self.refined, (last, cell), 0.02 * part * np.sqrt(n * len(own)).clip(max=4) * (value - self.refined[last, cell]))
                    if met is not None:
                        np.add.at(met.refined, (last, cell), part * times)
                if met is not None:
                    np.add.at(met.weights[bit], gate, times[:, None])
                np.clip(self.refined, 1e-6, 1 - 1e-6, out=self.refined)

    def log10_from(self, look: Look, window: np.ndarray) -> np.ndarray:
        """log10 probability of the byte of each window, with the counts that `look` gives."""
        total = np.zeros(len(window))
        for bit in range(8):
            value = (window >> np.uint64(7 - bit)) & np.uint64(1)
            seen = look(window, bit)
            p = self.final(window, self.mixed(bit, np.clip(_stretch(seen), -8, 8), (seen.sum(2) > 0).sum(0)))[0]
            total += np.log10(np.where(value == 1, p, 1 - p))
        return total

    def log10(self, stretched: np.ndarray, known: np.ndarray, window: np.ndarray) -> np.ndarray:
        """log10 probability of the byte of each window."""
        total = np.zeros(len(window))
        for bit in range(8):
            at, value = slots(window, bit)
            mixed = self.mixed(bit, stretched[at], known[at].sum(0))
            p = self.final(window, mixed)[0]
            total += np.log10(np.where(value == 1, p, 1 - p))
        return total


def _look(low: Counts, high: Counts) -> Look:
    return lambda window, bit: np.concatenate([low.seen(window, bit), high.seen(window, bit)])


def fit_mixer(counted: DataFrame, low: tuple, tasks: int) -> Mixer:
    """Learns from all windows with a count; tasks are averaged by what each weight row and cell has met."""
    mixer = Mixer.fresh()
    dealt = cut(counted.repartition(tasks, "shard"), "lm-learn")
    short, shape = counted.sparkSession.sparkContext.broadcast(low), mixer.weights.shape
    for turn in range(_ROUNDS):
        start, rate = mixer, 0.05 / (1 + turn)

        def learn(batches: Iterator[pa.RecordBatch], start: Mixer = start, rate: float = rate) -> Iterator[pa.RecordBatch]:
            own = Mixer(start.weights.copy(), start.refined.copy())
            met = Mixer(np.zeros(shape), np.zeros(own.refined.shape))
            few = Counts(*short.value, ORDERS[:_LOW])
            for batch in batches:
                for size, w, n in zip(*(batch.column(c).to_pylist() for c in ("size", "w", "n")), strict=True):
                    window, n = _unpacked_windows(w, size), _unpacked(n, size, np.int64)
                    look = _look(few, Counts(window, n, ORDERS[_LOW:]))
                    real = np.flatnonzero(n > 0)
                    real = real[np.argsort(mix(window[real]))]
                    own.steps(look, window[real], n[real], rate, met=met)
            flat = [np.concatenate([m.weights.ravel(), m.refined.ravel()]) for m in (own, met)]
            at = np.flatnonzero(flat[1])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[0][at] * flat[1][at]), pa.array(flat[1][at])], names=["at", "x", "n"])

        sums = dealt.mapInArrow(learn, "at long, x double, n double").groupBy("at").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).toPandas()
        flat = np.concatenate([mixer.weights.ravel(), mixer.refined.ravel()])
        flat[sums["at"].to_numpy(np.int64)] = (sums["x"] / sums["n"]).to_numpy(float)
        mixer = Mixer(flat[: mixer.weights.size].reshape(shape).copy(), flat[mixer.weights.size :].reshape(256, -1).copy())
    return mixer


def evaluate(counted: DataFrame, low: tuple, mixer: Mixer) -> DataFrame:
    """shard, size, w, p: log10 probability of each distinct window, written."""
    held = counted.sparkSession.sparkContext.broadcast((low, mixer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, own = held.value
        few = Counts(*short, ORDERS[:_LOW])
        for batch in batches:
            for shard, size, w, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "size", "w", "n")), strict=True):
                window, n = _unpacked_windows(w, size), _unpacked(n, size, np.int64)
                look = _look(few, Counts(window, n, ORDERS[_LOW:]))
                p = np.concatenate([own.log10_from(look, window[a : a + 100_000]) for a in range(0, size, 100_000)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([size], pa.int32()), pa.array([w], pa.binary()), pa.array([_packed(p.astype(np.float32))], pa.binary())],
                    names=["shard", "size", "w", "p"],
                )

    return cut(counted.mapInArrow(run, "shard int, size int, w binary, p binary"), "lm-values", outlives=True)


def look_up(asked: DataFrame, values: DataFrame) -> DataFrame:
    """unit, shard, size, w, p: the values of each unit's windows. A shard's values come before what is asked of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = p = None
        for batch in batches:
            for unit, shard, size, w, own in zip(*(batch.column(c).to_pylist() for c in ("unit", "shard", "size", "w", "p")), strict=True):
                if own is not None:
                    window, p = _unpacked_windows(w, size), _unpacked(own, size, np.float32)
                    continue
                mine = _packed(p[np.searchsorted(window, _unpacked_windows(w, size))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([unit]), pa.array([shard], pa.int32()), pa.array([size], pa.int32()), pa.array([w], pa.binary()), pa.array([mine], pa.binary())],
                    names=["unit", "shard", "size", "w", "p"],
                )

    kind = "unit long, shard int, size int, w binary, p binary"
    both = values.select(F.lit(-1).cast("long").alias("unit"), "shard", "size", "w", "p").unionByName(
        asked.select("unit", "shard", "size", "w", F.lit(None).cast("binary").alias("p"))
    )
    return both.repartition("shard").sortWithinPartitions("shard", "unit").mapInArrow(run, kind)


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the code of each word in turn, and the bounds of each text."""
    split = pc.ascii_split_whitespace(texts)
    offsets = split.offsets.to_numpy().astype(np.int64)
    words = split.values.slice(offsets[0], offsets[-1] - offsets[0])
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    coded = words.filter(pa.array(real)).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.concatenate([[0], np.cumsum(real)])[offsets - offsets[0]]


def count_tokens(texts: DataFrame) -> DataFrame:
    """token, n_all, c (in rows whose column `learn` is true), the end token included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, part in _slices(batch.column("text"), 8 * _SLICE_BYTES):
                words, codes, bounds = _tokens(part)
                learn = batch.column("learn").slice(a, len(part)).to_numpy(zero_copy_only=False).astype(bool)
                n_all = np.append(np.bincount(codes, minlength=len(words)), len(part))
                c = np.append(np.bincount(codes[np.repeat(learn, np.diff(bounds))], minlength=len(words)), learn.sum())
                tokens = pa.concat_arrays([words, pa.array([_END_TOKEN])])
                yield pa.RecordBatch.from_arrays([tokens, pa.array(n_all), pa.array(c)], names=["token", "n_all", "c"])

    parts = texts.select("text", "learn").mapInArrow(count, "token string, n_all long, c long")
    return parts.groupBy("token").agg(F.sum("n_all").alias("n_all"), F.sum("c").alias("c"))


def held_out(id_column: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


def _segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0.0], np.cumsum(values)])
    return running[bounds[1:]] - running[bounds[:-1]]


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Stretches of values or of texts of one unit."""
    unit = batch.column("unit").to_numpy()
    text = batch.column("shard").to_numpy() == _DOCS
    bounds = [0, *(np.flatnonzero((np.diff(unit) != 0) | (text[1:] != text[:-1])) + 1).tolist(), len(unit)]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if a < b:
            yield batch.slice(a, b - a)


def _answers(packed: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A unit's windows in order and their values, unpacked piece by piece; the list is used up."""
    size = sum(n for n, _, _ in packed)
    window, value, a = np.empty(size, np.uint64), np.empty(size, np.float32), 0
    while packed:
        n, w, p = packed.pop()
        window[a : a + n], value[a : a + n] = _unpacked_windows(w, n), _unpacked(p, n, np.float32)
        a += n
    by = np.argsort(window)
    return window[by], value[by]


def _scored(batch: pa.RecordBatch, held: dict, window: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Scored rows of texts; `window` (sorted) and `value` are those of their unit."""
    for a, part in _slices(batch.column("text")):
        words, codes, bounds = _tokens(part)
        at = pc.fill_null(pc.index_in(words, value_set=held["heavy"]), -1).to_numpy()
        c = held["c"][at]
        own = c[codes]
        logs = np.where(own >= 0, np.log10(np.maximum(own, 0) + 0.5), 0.0)
        owner = np.repeat(np.arange(len(part)), np.diff(bounds))
        rare = own < 0
        pair, n = np.unique(owner[rare] * max(len(words), 1) + codes[rare], return_counts=True)
        doc, code = np.divmod(pair, max(len(words), 1))
        rows = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(part)))]).astype(np.int32)
        tokens = pa.StructArray.from_arrays([words.take(pa.array(code)), pa.array(n)], names=["token", "n"])
        key, spots = windows(part)
        codes_w, distinct = pd.factorize(key)
        del key
        by, logs10 = np.argsort(distinct), np.empty(len(distinct))
        logs10[by] = value[np.searchsorted(window, distinct[by])]  # in order, so neighbours are found in the cache
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row").slice(a, len(part)),
                batch.column("id").slice(a, len(part)),
                batch.column("learn").slice(a, len(part)),
                pa.array(np.diff(bounds) + 1),
                pa.array(_segment_sums(own > 0, bounds).astype(np.int64) + (held["end"] > 0)),
                pa.array(_segment_sums(logs, bounds) + np.log10(held["end"] + 0.5)),
                pa.ListArray.from_arrays(pa.array(rows), tokens),
                pa.array(_segment_sums(logs10[codes_w], spots)),
                pa.array(np.diff(spots)),
            ],
            names=["row", "id", "learn", "n_tokens", "n_known", "logs", "rare", "score", "n_bytes"],
        )


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    heavy_parts: int = 500_000,
    max_windows: int = 150_000,
) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Texts are lower-cased (A-Z), NULL counts as empty, and rows whose id has
    crc32 1 modulo 5 are not learnt from; a NULL id counts as the empty text
    and is learnt from. `score` is the log10 probability of the lower-cased
    text's bytes and its end; `bits_per_byte` is the same per byte or end.
    Repeated rows count as often as they occur. Other columns are not looked
    at. An empty table gives an empty result. A shard is cut for eight bytes of
    text per `max_windows`, within bounds; a learning task takes about twice
    as many distinct windows.
    """
    with bounded_batches(docs.sparkSession), passing_shuffles(docs.sparkSession):  # all that Python does is written inside
        return _score_texts(docs, id_col, text_col, heavy_parts, max_windows)


def _score_texts(docs: DataFrame, id_col: str, text_col: str, heavy_parts: int, max_windows: int) -> DataFrame:
    spark = docs.sparkSession
    out = held_out(F.col(id_col))
    texts = docs.select(F.col(id_col).alias("id"), ascii_lower(F.col(text_col)).alias("text"), (~out).alias("learn"))
    counts = cut(count_tokens(texts), "lm-token-counts", codec="zstd")
    totals = counts.agg(F.sum("c").alias("n"), F.sum("n_all").alias("n_all"), F.count_if(F.col("c") > 0).alias("v")).head()
    n_train, n_kinds = totals["n"] or 0, totals["v"]
    least = (totals["n_all"] or 0) / heavy_parts
    heavy = counts.where((F.col("n_all") >= least) & (F.col("token") != _END_TOKEN)).select("token", "c").toPandas()
    end_count = counts.where(F.col("token") == _END_TOKEN).select("c").head()

    n_bytes = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    shards = int(np.clip(n_bytes // (8 * max_windows), *_SHARDS))
    with passing_cuts(spark):
        run, unit_kind = _units(shards, docs.schema[id_col].dataType.simpleString())
        units = cut(texts.select("id", "learn", "text").mapInArrow(run, unit_kind), "lm-units", codec="zstd")
        asked, whole_texts = units.where(F.col("shard") < _DOCS), units.where(F.col("shard") == _DOCS)
        with passing_cuts(spark):
            counted = count_windows(asked)
            low = _low_windows(counted)
            n_windows = counted.agg(F.sum("size")).head()[0] or 0
            values = evaluate(counted, low, fit_mixer(counted, low, max(2, n_windows // (2 * max_windows))))
        answered = look_up(asked, values)
        dealt = (
            whole_texts.select("unit", "shard", "row", "id", "learn", "text", "size", "w", F.lit(None).cast("binary").alias("p"))
            .unionByName(answered, allowMissingColumns=True)
            .repartition("unit")
            .sortWithinPartitions("unit", "shard", "row")
        )
        tokens = {
            "heavy": pa.array(heavy["token"], pa.string()),
            "c": np.append(heavy["c"].to_numpy(np.int64), -1),  # the last one stands for all other tokens
            "end": int(end_count["c"]) if end_count else 0,
        }
        model = spark.sparkContext.broadcast(tokens)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, answers = None, []
            for batch in batches:
                for part in _runs(batch):
                    if part.column("shard")[0].as_py() < _DOCS:
                        if own is not None:
                            own, answers = None, []
                        columns = (part.column(c).to_pylist() for c in ("size", "w", "p"))
                        answers += zip(*columns, strict=True)
                        continue
                    if own is None:
                        own = _answers(answers)
                    yield from _scored(part, model.value, *own)

        kind = docs.schema[id_col].dataType.simpleString()
        columns = (
            f"row long, id {kind}, learn boolean, n_tokens long, n_known long, logs double, "
            "rare array<struct<token:string,n:long>>, score double, n_bytes long"
        )
        scored = cut(dealt.mapInArrow(score, columns), "lm-scored", codec="zstd", outlives=True)
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.n")
    known = rare.join(counts.select("token", "c"), "token").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("rare_logs"),
    )
    whole = scored.drop("rare").join(known, "row", "left")
    per_token = float(np.log10(n_train + 0.5 * (n_kinds + 1)))
    return whole.select(
        F.col("id").alias(id_col),
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * per_token).alias("base_score"),
        "score",
        (-F.col("score") / float(np.log10(2)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
