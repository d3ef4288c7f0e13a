"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash of ``TRIGGER`` bytes marks, in every window of ``length`` bytes, the
leftmost smallest one: the window's trigger. Triggers cut each text into phrases (the
starts of the windows that share a trigger, with the bytes around it), the same
wherever the same bytes stand. Equal phrases are one dictionary entry: all windows of
its later occurrences are repeated, whatever their number. Only phrases that share a
trigger with a different phrase can hold further repeats. They are cut into a few
stretches, judged the same way by their whole and by the bytes all their windows
share; the suffixes of the stretches still in doubt are brought into order, as far as
``length`` bytes go, and the first place of each in the corpus is kept. Suffixes are ordered by a hash of those bytes, as only
their equality matters.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

from terralode.llm.common import saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRIGGER = 32
SEGMENT = 1 << 20  # a longer text is parsed in pieces that overlap by all that a phrase can reach
GATHER = 2 << 20
INDEX_BITS = 22  # of a place in a lot of texts, GATHER or one SEGMENT and its overlaps at most
HOT = 16  # phrases of one trigger in one lot of texts from which on they are dealt out one by one
BASE = np.uint64(0x9E3779B97F4A7C15)
ODD = np.uint64(0xBF58476D1CE4E5B9)
MARKER, PLAIN, SPREAD, REPEATED = 0, 1, 2, 3
PARTS = 4
PHRASES = "spot bigint, phrase bigint, doc_id bigint, place bigint"
STRETCHES = "inner_hash bigint, whole_hash bigint, doc_id bigint, at bigint, low bigint, n int, skip int, bytes binary"
WINDOWS = "w0 bigint, w1 int, doc_id bigint, start bigint, n int"
KEPT = "doc_id bigint, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept {}"


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= ODD
    x ^= x >> np.uint64(29)
    return x


class Rolling:
    """Hashes of any byte run in constant time each, by running sums of a polynomial modulo 2**64."""

    def __init__(self):
        self.values = np.random.default_rng(20).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        self.power = self.back = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        if len(self.power) <= len(data):
            size = max(len(data) + 1, GATHER + 4096)
            self.power = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, BASE)]))
            self.back = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, self.inverse)]))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values[data] * self.power[: len(data)], dtype=np.uint64)])

    def all_of(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.back[:n]) if n > 0 else np.empty(0, np.uint64)

    def runs(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.back[begin]


def leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each place the index of the leftmost smallest of the next ``width`` values, as far as their upper bits tell.

    The index takes the place of the lower bits, whatever the lot's size: equal windows choose the same place in any lot.
    """
    low = np.uint64((1 << INDEX_BITS) - 1)
    best, size = values & ~low | np.arange(len(values), dtype=np.uint64), 1
    while size < width:
        step = min(size, width - size)
        best = np.minimum(best[step:], best[:-step])
        size += step
    return (best & low).astype(np.int32)


def parse(texts: list[tuple[int, bytes]], length: int, rolling: Rolling):
    """Phrases of a lot of texts: trigger hash, phrase hash, document, trigger's place, and first and last start owned."""
    width, reach = length - TRIGGER + 1, length + TRIGGER
    lots: list[list[tuple[int, int, int, bytes]]] = [[]]
    size = 0
    for doc, data in texts:
        for at in range(0, max(0, len(data) - length + 1), SEGMENT):
            begin, end = max(0, at - reach), min(len(data), at + SEGMENT + 2 * reach)
            if size + end - begin > GATHER and lots[-1]:
                lots.append([])
                size = 0
            lots[-1].append((doc, at, begin, data[begin:end] if end - begin < len(data) else data))
            size += end - begin
    whole = {doc: len(data) for doc, data in texts}
    found = []
    for lot in lots:
        if not lot:
            continue
        data = np.frombuffer(b"".join(x[3] for x in lot), np.uint8)
        rolling.load(data)
        hashes = rolling.all_of(TRIGGER)
        smallest = leftmost_smallest(hashes, width)
        base = 0
        docs, triggers, phrases, places, firsts, lasts = [], [], [], [], [], []
        for doc, at, begin, part in lot:
            # Starts of windows that this segment answers for, in the lot's coordinates.
            low = base + at - begin
            high = base + min(at + SEGMENT, whole[doc] - length + 1) - begin
            owner = smallest[low:high]
            cut = np.flatnonzero(np.diff(owner, prepend=-1))
            t = owner[cut].astype(np.int64)
            docs.append(np.full(len(cut), doc))
            triggers.append(t)
            places.append(t - base + begin)
            firsts.append(cut + low - base + begin)
            lasts.append(np.append(cut[1:], len(owner)) - 1 + low - base + begin)
            left = np.minimum(t - base, length - TRIGGER)
            right = np.minimum(base + len(part) - t, length)
            ends = left.astype(np.uint64) * BASE ^ right.astype(np.uint64) * ODD
            phrases.append(mixed(rolling.runs(t - left, t + right) + ends))
            base += len(part)
        t = np.concatenate(triggers)
        found.append((hashes[t], np.concatenate(phrases), np.concatenate(docs), np.concatenate(places), np.concatenate(firsts), np.concatenate(lasts)))
    if not found:
        return tuple(np.empty(0, k) for k in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))


def phrase_lister(length: int):
    def lot(ids: list[int], texts: list[bytes], rolling: Rolling) -> pa.RecordBatch:
        trigger, phrase, doc, at, first, last = parse(list(enumerate(texts)), length, rolling)
        doc_id = np.array(ids, np.int64)[doc.astype(np.int64)]
        order = np.lexsort((at, doc_id, phrase, trigger))
        trigger, phrase, doc_id, at, first, last = (x[order] for x in (trigger, phrase, doc_id, at, first, last))
        again = np.zeros(len(at), bool)
        again[1:] = (trigger[1:] == trigger[:-1]) & (phrase[1:] == phrase[:-1])
        again[1:] &= (doc_id[1:] != doc_id[:-1]) | (at[1:] != at[:-1])
        # A repeat within the lot is known at once; of what remains, triggers of many phrases are dealt out by phrase.
        _, group, count = np.unique(trigger[~again], return_inverse=True, return_counts=True)
        kind = np.where(again, REPEATED, PLAIN)
        kind[~again] = np.where(count[group] >= HOT, SPREAD, PLAIN)
        spot = np.where(kind == PLAIN, trigger, mixed(trigger + phrase * BASE))
        spot = np.where(kind == REPEATED, mixed(spot + (doc_id * 1_000_003 + at).view(np.uint64)), spot)
        place = at << 18 | (at - first) << 10 | (at - last) << 2 | kind
        hot = np.unique(trigger[kind == SPREAD])
        zeros = np.zeros(len(hot), np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([spot, hot]).view(np.int64)),
                pa.array(np.concatenate([phrase.view(np.int64), zeros])),
                pa.array(np.concatenate([doc_id, zeros])),
                pa.array(np.concatenate([place, zeros + MARKER])),
            ],
            names=["spot", "phrase", "doc_id", "place"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, ids, texts, size = Rolling(), [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append((text.as_py() or "").encode())
                size += len(texts[-1])
                if size >= 4 * GATHER:
                    yield lot(ids, texts, rolling)
                    ids, texts, size = [], [], 0
        if ids:
            yield lot(ids, texts, rolling)

    return run


def unpacked(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window start of packed places."""
    at = marks >> 18
    return at - (marks >> 10 & 255), at - (marks >> 2 & 255)


def spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one after the other."""
    size = last - first + 1
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def stretch_lister(length: int):
    """Stretches of the phrases still in doubt, of rows ``doc_id, text, doubted``; a null text and further columns are passed over.

    A window starts 0 to ``length - TRIGGER`` bytes before its trigger; a stretch has the windows of one of
    PARTS ranges of that distance. Its inner bytes lie in each of them, its whole bytes in one or another.
    The texts are taken in lots of about ``GATHER`` bytes, marks included, each hashed at once.
    """
    bounds = np.linspace(0, length - TRIGGER + 1, PARTS + 1).astype(np.int64)

    def stretches(lot: list[tuple[int, int, pa.Buffer, np.ndarray]], rolling: Rolling) -> pa.RecordBatch:
        raw = b"".join(x[2] for x in lot)
        rolling.load(np.frombuffer(raw, np.uint8))
        sizes = np.array([len(x[2]) for x in lot], np.int64)
        row = np.repeat(np.arange(len(lot)), [len(x[3]) for x in lot])
        floor, ceiling = (np.cumsum(sizes) - sizes)[row], np.cumsum(sizes)[row]
        # From places in a document to places in the lot; no stretch leaves its own text.
        shift = floor - np.array([x[1] for x in lot], np.int64)[row]
        doc_id, marks = np.array([x[0] for x in lot], np.int64)[row], np.concatenate([x[3] for x in lot])
        at = (marks >> 18) + shift
        first, last = (x + shift for x in unpacked(marks))
        found = []
        for part in range(PARTS):
            near, far = bounds[part], bounds[part + 1] - 1
            lows, highs = np.maximum(first, at - far), np.minimum(last, at - near)
            held = np.flatnonzero((lows <= highs) & (lows >= floor) & (highs + length <= ceiling))
            t, lo, hi = at[held], lows[held], highs[held]
            left, right = np.maximum(floor[held], t - far), np.minimum(ceiling[held], t - near + length)
            salt = np.full(1, part + 1, np.uint64) * ODD
            inner = mixed(rolling.runs(t - near, t - far + length) + salt)
            clip = (t - left).astype(np.uint64) * BASE ^ (right - t).astype(np.uint64) * ODD
            whole = mixed(rolling.runs(left, right) + clip)
            back, n, skip = shift[held], (hi - lo + 1).astype(np.int32), (lo - left).astype(np.int32)
            found.append((inner.view(np.int64), whole.view(np.int64), doc_id[held], t - back, lo - back, n, skip, left, right))
        *columns, left, right = (np.concatenate(x) for x in zip(*found))
        cut = pa.array([raw[x:y] for x, y in zip(left.tolist(), right.tolist())], pa.binary())
        names = ["inner_hash", "whole_hash", "doc_id", "at", "low", "n", "skip", "bytes"]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), cut], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            lot, size = [], 0
            for doc_id, text, doubted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if not text.is_valid or not doubted.is_valid:
                    continue
                raw, marks = text.as_buffer(), doubted.values.to_numpy()
                if len(raw) > SEGMENT:
                    marks = np.sort(marks)
                for low in range(0, len(raw), SEGMENT):
                    own = marks
                    if len(raw) > SEGMENT:
                        own = marks[np.searchsorted(marks, low << 18) : np.searchsorted(marks, low + SEGMENT << 18)]
                    if not len(own):
                        continue
                    begin = max(0, low - length)
                    part = raw.slice(begin, min(len(raw), low + SEGMENT + length) - begin)
                    if lot and size + len(part) + own.nbytes > GATHER:
                        yield stretches(lot, rolling)
                        lot, size = [], 0
                    lot.append((doc_id, begin, part, own))
                    size += len(part) + own.nbytes
            if lot:
                yield stretches(lot, rolling)

    return run


def window_lister(length: int):
    """Of rows ``doc_id, low, n, skip, bytes, shared``: a shared stretch's windows by hash, one row each; another as it is, under a key of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            doc_id, low, n, skip = (batch.column(c).to_numpy() for c in range(4))
            shared = batch.column(5).to_numpy(zero_copy_only=False)
            rolling.load(np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8))
            sizes = pa.compute.binary_length(batch.column(4)).to_numpy().astype(np.int64)
            begin = np.cumsum(sizes) - sizes + skip
            own, size = begin[shared], n[shared].astype(np.int64)
            at = spread(own, own + size - 1) if len(own) else own
            raw = rolling.runs(at, at + length)
            other = mixed(rolling.runs(at, at + length // 2) + raw * BASE)
            alone = ~shared
            key = mixed((doc_id[alone] * 1_000_003 + low[alone]).view(np.uint64) * ODD)
            starts = spread(low[shared], low[shared] + size - 1) if len(own) else low[shared]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([mixed(raw), key]).view(np.int64)),
                    pa.array(np.concatenate([(other >> np.uint64(32)).astype(np.uint32).view(np.int32), np.full(len(key), -1, np.int32)])),
                    pa.array(np.concatenate([np.repeat(doc_id[shared], size), doc_id[alone]])),
                    pa.array(np.concatenate([starts, low[alone]])),
                    pa.array(np.concatenate([np.ones(len(starts), np.int32), n[alone]])),
                ],
                names=["w0", "w1", "doc_id", "start", "n"],
            )

    return run


def listed(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The row of each value of a column of lists, and the values; a null list has none."""
    return np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy()), column.flatten().to_numpy()


def remover(length: int, as_text: bool):
    """What is left of rows ``doc_id, text, repeated, doubted, first``; further columns are carried along."""

    def lot(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.as_buffer() if t.is_valid else b"" for t in rows.column(1)]
        sizes = np.array([len(t) for t in texts], np.int64)
        # One byte apart, so that no run of starts goes over into the next text.
        base = np.cumsum(sizes + 1) - sizes - 1
        (again, repeated), (unsure, doubted), (new, first) = (listed(rows.column(c)) for c in (2, 3, 4))
        ranges = [(again, *unpacked(repeated)), (unsure, *unpacked(doubted)), (new, first >> 8, (first >> 8) + (first & 255) - 1)]
        cut = []
        for row, low, high in ranges:
            high = np.minimum(high, sizes[row] - length)
            held = low <= high
            cut.append(((low + base[row])[held], (high + base[row])[held] + 1))
        edges = np.unique(np.concatenate([x for pair in cut for x in pair]))
        inside = []
        for low, past in cut:
            depth = np.zeros(len(edges), np.int64)
            np.add.at(depth, np.searchsorted(edges, low), 1)
            np.subtract.at(depth, np.searchsorted(edges, past), 1)
            inside.append(np.cumsum(depth) > 0)
        starts = np.flatnonzero(inside[0] | inside[1] & ~inside[2])
        low, high = edges[starts], edges[starts + 1] - 1
        opens = np.flatnonzero(low - np.concatenate([[-length - 1], high[:-1]])[: len(low)] > length)
        begin, end = low[opens], high[np.append(opens[1:], len(low))[: len(opens)] - 1] + length
        row = np.searchsorted(base, begin, "right") - 1
        begin, end = begin - base[row], end - base[row]
        bounds = np.searchsorted(row, np.arange(len(texts) + 1))
        kept, gone = [], list(zip(begin.tolist(), end.tolist()))
        for text, x, y in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist()):
            data, parts, done = memoryview(text), [], 0
            for b, e in gone[x:y]:
                parts.append(data[done:b])
                done = e
            kept.append(b"".join([*parts, data[done:]]))
        spans = pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], names=["begin", "end"])
        left = pa.array([k.decode("utf-8", "ignore") for k in kept]) if as_text else pa.array(kept, pa.binary())
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans), left, *rows.columns[5:]],
            names=["doc_id", "n_bytes", "spans", "kept", *rows.schema.names[5:]],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy().astype(np.int64)
            sizes += 8 * sum(batch.column(c).value_lengths().fill_null(0).to_numpy().astype(np.int64) for c in (2, 3, 4))
            begun, room = 0, 0
            for r, size in enumerate(sizes.tolist(), 1):
                room += size
                if room >= 4 * GATHER or r == batch.num_rows:
                    yield lot(batch.slice(begun, r - begun))
                    begun, room = r, 0

    return run


def remove_repeats(docs: DataFrame, length: int = 100, keep: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` and the columns ``keep``: every row's text as UTF-8 without its repeated bytes.

    A byte goes if a run of ``length`` bytes that covers it also starts earlier, in a
    document of a smaller doc_id or before it in its own; overlaps count, runs never
    cross documents, and all is judged on the texts as given. ``spans`` are the maximal
    runs removed; ``as_text`` gives what is left as a string, without the characters that
    a run cuts through. A null text counts as empty. A row without doc_id is left whole and
    repeats nothing. Rows of one doc_id are taken as one document and must have one
    text. An empty table gives no rows. ``length`` is from 64 to 255.
    """
    if not 2 * TRIGGER <= length <= 255:
        raise ValueError("length is from 64 to 255")
    keep = keep or []
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep)
    phrases = base.select("doc_id", "text").where("doc_id is not null").mapInArrow(phrase_lister(length), PHRASES).repartition("spot")
    kind, at = F.col("place").bitwiseAND(F.lit(3)), F.shiftright("place", 18)
    same = Window.partitionBy("spot", "phrase").orderBy("doc_id", "place")
    group = Window.partitionBy("spot")
    real = F.when(kind != MARKER, F.col("phrase"))
    judged = (
        phrases.withColumn("earliest", F.first(F.when(kind != MARKER, F.struct("doc_id", at.alias("at"))), ignorenulls=True).over(same))
        .withColumn("lowest", F.min(real).over(group))
        .withColumn("highest", F.max(real).over(group))
        .withColumn("marked", F.min(kind).over(group) == MARKER)
        .where(kind != MARKER)
    )
    judged = judged.withColumn("repeated", (kind == REPEATED) | (F.struct("doc_id", at.alias("at")) != F.col("earliest")))
    doubted = (kind == SPREAD) | F.col("marked") | (F.col("lowest") != F.col("highest"))
    marks = (
        judged.where(F.col("repeated") | doubted)
        .groupBy("doc_id")
        .agg(
            F.collect_list(F.when(F.col("repeated"), F.col("place"))).alias("repeated"),
            F.collect_list(F.when(~F.col("repeated"), F.col("place"))).alias("doubted"),
        )
    )
    marks = saved(marks, "phrases")
    # The texts are dealt once, for both joins: the first takes no filter and drops no column, which would make it another shuffle.
    dealt = base.repartition("doc_id")
    in_doubt = dealt.join(marks.select("doc_id", "doubted").hint("shuffle_hash"), "doc_id", "left")
    held = [F.when(F.size("doubted") > 0, F.col(c)).alias(c) for c in ("text", *keep)]
    in_doubt = in_doubt.select("doc_id", held[0], "doubted", *held[1:])
    stretches = in_doubt.mapInArrow(stretch_lister(length), STRETCHES).repartition("inner_hash")
    alike = Window.partitionBy("inner_hash", "whole_hash").orderBy("doc_id", "at")
    inside = Window.partitionBy("inner_hash")
    new = (
        stretches.withColumn("earliest", F.first(F.struct("doc_id", "at")).over(alike))
        .withColumn("shared", F.min("whole_hash").over(inside) != F.max("whole_hash").over(inside))
        .where(F.struct("doc_id", "at") == F.col("earliest"))
    )
    windows = new.select("doc_id", "low", "n", "skip", "bytes", "shared").mapInArrow(window_lister(length), WINDOWS)
    firsts = windows.groupBy("w0", "w1").agg(F.min(F.struct("doc_id", "start", "n")).alias("m"))
    firsts = firsts.groupBy(F.col("m.doc_id").alias("doc_id")).agg(F.collect_list(F.shiftleft("m.start", 8).bitwiseOR(F.col("m.n"))).alias("first"))
    found = marks.join(firsts, "doc_id", "left")
    whole = dealt.join(found.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "repeated", "doubted", "first", *keep)
    schema = T.StructType.fromDDL(KEPT.format("string" if as_text else "binary"))
    schema = T.StructType([*schema.fields, *(base.schema[c] for c in keep)])
    return whole.mapInArrow(remover(length, as_text), schema)


def digest(kept: DataFrame) -> DataFrame:
    """Counts and a checksum in place of the spans and bytes."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["begin"])
    return kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
