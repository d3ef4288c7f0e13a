"""Token counts without ids: each distinct pre-token is counted once, documents sum over their pre-tokens.

A task gathers its documents in chunks. A chunk lists its distinct pre-tokens and,
packed in a few bytes a pair, which document holds which how often. Only the
lists are dealt out by pre-token, where equal ones of all chunks come together and
the library counts each once. The counts go back to their chunks, which sum them.
A pre-token found everywhere has one row per chunk, so no key is hot.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

from terralode.llm.byte_bpe import ByteBpe
from terralode.llm.common import saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNKS = "chunk bigint, pieces array<string>, docs binary, terms binary"
COUNTED = "chunk bigint, counts binary"
LOT_PIECES = 1 << 19
RESULT = "doc_id bigint, n_bytes bigint, n_tokens bigint"


class Numbering(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def to_bytes(**columns) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.table(columns)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


class Chunk:
    """Documents gathered for one row of output; their pairs are drawn together lot by lot."""

    def __init__(self, number: int):
        self.number, self.numbers = number, Numbering()
        self.ids, self.bytes = [], []
        self.lot: list[np.ndarray] = []
        self.lot_pieces = self.gathered = 0
        self.docs, self.held, self.freqs = [], [], []

    def add(self, doc_id: int, n_bytes: int, pieces: list[str]) -> None:
        self.ids.append(doc_id)
        self.bytes.append(n_bytes)
        self.lot.append(np.fromiter(map(self.numbers.__getitem__, pieces), np.int32, len(pieces)))
        self.gathered += n_bytes
        self.lot_pieces += len(pieces)
        if self.lot_pieces >= LOT_PIECES:
            self.close_lot()

    def close_lot(self) -> None:
        """The lot's documents as (document, number, frequency)."""
        first, width = len(self.ids) - len(self.lot), max(1, len(self.numbers))
        doc = np.repeat(np.arange(len(self.lot), dtype=np.int64), [len(x) for x in self.lot])
        pairs, freq = np.unique(doc * width + np.concatenate([*self.lot, np.empty(0, np.int32)]), return_counts=True)
        doc, number = np.divmod(pairs, width)
        self.docs.append((doc + first).astype(np.int32))
        self.held.append(number.astype(np.int32))
        self.freqs.append(freq.astype(np.int32))
        self.lot, self.lot_pieces = [], 0

    def row(self) -> pa.RecordBatch:
        """Pre-tokens from the most frequent on, and each document's pairs in that order, numbers as differences."""
        self.close_lot()
        doc, number, freq = (np.concatenate(x) for x in (self.docs, self.held, self.freqs))
        order = np.argsort(-np.bincount(number, freq, len(self.numbers)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        number = rank[number]
        by = np.lexsort((number, doc))
        doc, number, freq = doc[by], number[by], freq[by]
        step = np.diff(number, prepend=np.int32(0))
        first = np.diff(doc, prepend=np.int32(-1)) != 0
        step[first] = number[first]
        pieces = pa.array(self.numbers.keys(), pa.string()).take(pa.array(order))
        n_terms = np.bincount(doc, minlength=len(self.ids))
        docs = to_bytes(doc_id=pa.array(self.ids, pa.int64()), n_bytes=pa.array(self.bytes, pa.int64()), n_terms=n_terms)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.number]),
                pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces),
                pa.array([docs], pa.binary()),
                pa.array([to_bytes(step=step, freq=freq)], pa.binary()),
            ],
            names=["chunk", "pieces", "docs", "terms"],
        )


def chunker(spec, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, serial = ByteBpe(spec.value), TaskContext.get().partitionId(), 0
        chunk = Chunk(part << 33)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                chunk.add(doc_id, len(text.encode()), bpe.pre_tokens(text))
                if chunk.gathered >= chunk_bytes:
                    yield chunk.row()
                    serial += 1
                    chunk = Chunk(part << 33 | serial)
        if chunk.ids:
            yield chunk.row()

    return run


def counter(spec):
    """Rows sorted by piece: each run of equal pieces is counted once.

    The counts are gathered by chunk and packed. Pieces of one token, the rule, are left out.
    """

    def packed(chunks: list, places: list, lengths: list) -> pa.RecordBatch:
        chunk, pos, n = (np.concatenate(x) for x in (chunks, places, lengths))
        order = np.lexsort((pos, chunk))
        chunk, pos, n = chunk[order], pos[order], n[order]
        cut = np.flatnonzero(np.diff(chunk, prepend=-1))
        ends = np.append(cut[1:], len(chunk))
        blobs = [to_bytes(step=np.diff(pos[a:b], prepend=np.int32(0)), n=n[a:b]) for a, b in zip(cut, ends)]
        return pa.RecordBatch.from_arrays([pa.array(chunk[cut]), pa.array(blobs, pa.binary())], names=["chunk", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, last, last_n, held = ByteBpe(spec.value), None, 0, 0
        out: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            piece = batch.column(2).dictionary_encode()
            distinct = piece.dictionary.to_pylist()
            lengths = np.array(bpe.lengths(distinct) if distinct[:1] != [last] else [last_n, *bpe.lengths(distinct[1:])], np.int32)
            if len(distinct):
                last, last_n = distinct[-1], int(lengths[-1])
            n = lengths[piece.indices.to_numpy()]
            more = n != 1
            for column, values in zip(out, (batch.column(0).to_numpy(), batch.column(1).to_numpy(), n)):
                column.append(values[more])
            held += int(more.sum())
            if held >= LOT_PIECES:
                yield packed(*out)
                out, held = ([], [], []), 0
        if held:
            yield packed(*out)

    return run


def sum_chunk(counts: pa.Table, chunk: pa.Table) -> pa.Table:
    docs, terms = (from_bytes(chunk.column(c)[0].as_py()) for c in ("docs", "terms"))
    n_terms = docs.column("n_terms").to_numpy()
    step = terms.column("step").to_numpy().astype(np.int64)
    starts = np.cumsum(n_terms) - n_terms
    # Differences start anew with each document: running sums less what ran before the document.
    run = np.cumsum(step)
    before = np.concatenate([[0], run])[starts]
    number = run - np.repeat(before, n_terms)
    n = np.ones(int(number.max()) + 1 if len(number) else 0, np.int64)
    for blob in counts.column("counts").to_pylist():
        found = from_bytes(blob)
        n[np.cumsum(found.column("step").to_numpy())] = found.column("n").to_numpy()
    sums = np.concatenate([[0], np.cumsum(n[number] * terms.column("freq").to_numpy())])
    tokens = sums[starts + n_terms] - sums[starts]
    return pa.table({"doc_id": docs.column("doc_id"), "n_bytes": docs.column("n_bytes"), "n_tokens": pa.array(tokens, pa.int64())})


def count_tokens(docs: DataFrame, spec_text: str, limit: int = 1024, chunk_bytes: int = 14 << 20) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    ``n_tokens`` is what the tokenizers library gives for the whole text, special
    strings inside it included; ``over_limit`` is n_tokens > ``limit``. A null text
    counts as empty: 0 bytes, 0 tokens. Repeated rows and rows without doc_id are
    counted each on their own; an empty table gives no rows; other columns are not
    looked at. ``chunk_bytes`` bounds the text a task gathers, but for one longer text.
    """
    spec = docs.sparkSession.sparkContext.broadcast(spec_text)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = saved(texts.mapInArrow(chunker(spec, chunk_bytes), CHUNKS), "chunks")
    listed = chunks.select("chunk", F.posexplode("pieces").alias("pos", "piece"))
    counts = listed.repartition("piece").sortWithinPartitions("piece").mapInArrow(counter(spec), COUNTED)
    summed = counts.groupBy("chunk").cogroup(chunks.select("chunk", "docs", "terms").groupBy("chunk")).applyInArrow(sum_chunk, RESULT)
    return summed.withColumn("over_limit", F.col("n_tokens") > limit)
