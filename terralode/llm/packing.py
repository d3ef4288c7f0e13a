"""Packing of token sequences into windows of a fixed size: bounded-space online best fit.

Each task reads its documents once and keeps a fixed number of open windows. A
document's full windows stand alone; what is left of it goes into the open window
it fills best. When none has room and all places are taken, the fullest is
emitted, first topped up with the head of the document if the gap is worth a cut.
The windows still open when a task ends are merged, a few tasks' worth at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

from terralode.llm.byte_bpe import ByteBpe
from terralode.llm.common import saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECES = "doc_id bigint, start bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, part bigint, closed boolean"
MERGED = "doc_id bigint, start bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
SERIAL_BITS = 33
MERGED_FLAG = 1 << 62
FLUSH_BYTES = 4 << 20


class Rows:
    """Columns of output rows, handed on as a batch when enough have gathered."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.columns, self.size = schema, [[] for _ in schema], 0

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)
        self.size += 64 + len(values[2])

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)]
        self.columns, self.size = [[] for _ in self.schema], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def online_packer(spec, window: int, end_id: int, open_windows: int, worth_a_cut: int):
    """A task's function: texts in, pieces of windows out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = ByteBpe(spec.value), TaskContext.get().partitionId()
        out, serial, open_ = Rows(arrow_schema(PIECES)), 0, []  # an open window: [used, pieces]

        def emit(pieces, closed):
            nonlocal serial
            sequence, offset = part << SERIAL_BITS | serial, 0
            serial += 1
            for doc_id, start, ids, tokens in pieces:
                out.add(doc_id, start, ids, tokens, sequence, offset, part, closed)
                offset += len(ids) // 4

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = bpe.encode(text.as_py() or "").astype("<u4").tobytes() + end_id.to_bytes(4, "little")
                tokens, at = len(ids) // 4, 0
                while tokens - at >= window:
                    emit([(doc_id, at, ids[4 * at : 4 * (at + window)], tokens)], True)
                    at += window
                while at < tokens:
                    rest = tokens - at
                    best = max((w for w in open_ if w[0] + rest <= window), key=lambda w: w[0], default=None)
                    if best is None and len(open_) < open_windows:
                        open_.append(best := [0, []])
                    if best is None:  # the fullest goes, topped up
                        fullest = max(open_, key=lambda w: w[0])
                        gap = window - fullest[0]
                        if gap >= worth_a_cut:
                            fullest[1].append((doc_id, at, ids[4 * at : 4 * (at + gap)], tokens))
                            at += gap
                        emit(fullest[1], True)
                        open_.remove(fullest)
                        continue
                    best[0] += rest
                    best[1].append((doc_id, at, ids[4 * at :], tokens))
                    at = tokens
                    if best[0] == window:
                        emit(best[1], True)
                        open_.remove(best)
                if out.size >= FLUSH_BYTES:
                    yield out.batch()
        for used, pieces in open_:
            emit(pieces, window - used < worth_a_cut)
        yield out.batch()

    return run


def merger(window: int):
    """Lays the open windows of a few tasks end to end and cuts them anew; one window at most stays short."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        out, serial, used = Rows(arrow_schema(MERGED)), 0, 0
        for doc_id, start, ids, tokens in zip(*(table.column(n).to_pylist() for n in ("doc_id", "start", "ids", "doc_tokens"))):
            while ids:
                taken = ids[: 4 * (window - used)]
                out.add(doc_id, start, taken, tokens, MERGED_FLAG | key[0].as_py() << SERIAL_BITS | serial, used)
                ids, start, used = ids[len(taken) :], start + len(taken) // 4, used + len(taken) // 4
                if used == window:
                    serial, used = serial + 1, 0
        return pa.Table.from_batches([out.batch()])

    return run


def pack(
    docs: DataFrame,
    spec_text: str,
    window: int = 2048,
    end_id: int = 1,
    open_windows: int = 64,
    worth_a_cut: int = 64,
    merged_tasks: int = 8,
) -> DataFrame:
    """Pieces ``doc_id, start, length, ids, doc_tokens, sequence_id, offset`` of windows of ``window`` ids.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. A null
    text counts as empty; every document, empty or not, ends in ``end_id`` and so
    has a piece; rows without a doc_id are packed under null, repeated rows each on
    their own; an empty table gives no rows. Other columns are not looked at.

    The pieces are written to the shared folder once, so that what a task packed
    stays as it is if the task's executor is lost; only the open windows (at most
    ``open_windows`` a task) are shuffled, in groups of ``merged_tasks`` tasks.
    """
    spec = docs.sparkSession.sparkContext.broadcast(spec_text)
    packed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        online_packer(spec, window, end_id, open_windows, worth_a_cut), PIECES
    )
    packed = saved(packed, "packed")
    columns = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
    group = F.floor(F.col("part") / merged_tasks).cast("bigint").alias("tasks")
    merged = packed.where(~F.col("closed")).groupBy(group).applyInArrow(merger(window), MERGED)
    whole = packed.where("closed").select(*columns).unionByName(merged)
    return whole.select("doc_id", "start", F.expr("cast(octet_length(ids) / 4 as bigint)").alias("length"), *columns[2:])
