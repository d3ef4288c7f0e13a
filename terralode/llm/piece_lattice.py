"""SentencePiece encoding, decoding and N-best segmentation over the lattice of a model's pieces.

Spaces become the mark that pieces carry, so the lattice falls apart wherever a mark
follows another character: no piece crosses there. Each distinct section is searched
once in a task: forward Viterbi scores are exact estimates of what lies before a
place, and A* runs backward over them, so the n best paths come out in order. A
text's n best are the n best choices among its sections' paths.
"""

from __future__ import annotations

import heapq
import math
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "▁"
ENCODED = "doc_id bigint, nbest array<struct<score:double,n_pieces:bigint,ids:binary>>"
SECTIONS_KEPT = 1 << 19
BATCH_CHARS = 4_000_000


def read_model(path: str) -> bytes:
    """A model file's bytes: a vocabulary, whatever the data, so that it can travel with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def packed_ids(ids: tuple[int, ...]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return array("I", ids).tobytes()


class Starts(dict):
    """Pieces by their characters: nodes ``[score, ids, nodes by next character]``, ids empty where no piece ends.

    A first character always has ids, those of its bytes or the unknown piece if need be.
    """

    def __init__(self, lattice: Lattice):
        self.fallback = lattice.fallback
        for piece, (score, ids) in lattice.pieces.items():
            nodes, node = self, None
            for k, character in enumerate(piece):
                if k:
                    nodes = node[2] = {} if node[2] is None else node[2]
                node = nodes.get(character)
                if node is None:
                    node = nodes[character] = [0.0, b"", None]
            node[0], node[1] = score, packed_ids(ids)
        for character in [c for c, node in self.items() if not node[1]]:
            score, ids = self.fallback(character)
            self[character][:2] = score, packed_ids(ids)

    def __missing__(self, character: str) -> list:
        score, ids = self.fallback(character)
        self[character] = node = [score, packed_ids(ids), None]
        return node


class Lattice:
    """Pieces and scores of a model, and the best paths through sections of text."""

    def __init__(self, model: bytes, n: int):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = processor.get_piece_size()
        names = [processor.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i) or processor.is_byte(i))]
        self.pieces = {names[i]: (processor.get_score(i), (i,)) for i in plain}
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(size) if processor.is_byte(i)}
        self.unknown = (processor.unk_id(), min((processor.get_score(i) for i in plain), default=0.0) - 10.0)
        # Sections end before a mark unless some piece reaches over such a place.
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces)
        self.sections = re.compile(r"(?s).+" if crossing else f"(?s){MARK}*[^{MARK}]+|{MARK}+")
        self.names, self.n = names, n
        self.bytes_of_id = {i: b for b, i in self.byte_ids.items()}
        self.whole_mark = self.fallback(MARK)
        self.starts = Starts(self)
        self.first: dict[str, tuple[float, bytes, float]] = {}
        self.paths: dict[str, list[tuple[float, bytes]]] = {}

    def fallback(self, character: str) -> tuple[float, tuple[int, ...]]:
        """A character that is no piece goes as its bytes, or as the unknown piece where the model has no bytes."""
        raw = character.encode()
        if all(b in self.byte_ids for b in raw):
            return 0.0, tuple(self.byte_ids[b] for b in raw)
        return self.unknown[1], (self.unknown[0],)

    def forward(self, section: str):
        """All pieces as (begin, end, score, ids) by begin, and by place the best score before it."""
        starts, size = self.starts, len(section)
        arcs: list[tuple[int, int, float, bytes]] = []
        ahead = [0.0] + [-math.inf] * size
        for i in range(size):
            so_far, j = ahead[i], i + 1
            score, ids, after = starts[section[i]]
            while True:
                if ids:
                    if so_far + score > ahead[j]:
                        ahead[j] = so_far + score
                    arcs.append((i, j, score, ids))
                node = after.get(section[j]) if after is not None and j < size else None
                if node is None:
                    break
                score, ids, after = node
                j += 1
        return arcs, ahead

    def best(self, section: str) -> tuple[float, bytes, float]:
        """The best path's score and little-endian unsigned 32-bit ids, and how much less the second best scores."""
        found = self.first.get(section)
        if found is None:
            if len(self.first) >= SECTIONS_KEPT:
                self.first.clear()
            starts, size = self.starts, len(section)
            # By place: the best and the second best score before it, and where the best path's last piece begins and its ids.
            ahead, second = [0.0] + [-math.inf] * size, [-math.inf] * (size + 1)
            begin, own = [0] * (size + 1), [b""] * (size + 1)
            for i in range(size):
                so_far, next_best, j = ahead[i], second[i], i + 1
                score, ids, after = starts[section[i]]
                while True:
                    if ids:
                        reached, known = so_far + score, ahead[j]
                        if reached > known:
                            other = next_best + score
                            second[j] = known if known > other else other
                            ahead[j], begin[j], own[j] = reached, i, ids
                        elif reached > second[j]:
                            second[j] = reached
                    if after is None or j == size:
                        break
                    node = after.get(section[j])
                    if node is None:
                        break
                    score, ids, after = node
                    j += 1
            parts, at = [], size
            while at:
                parts.append(own[at])
                at = begin[at]
            parts.reverse()
            found = self.first[section] = (ahead[-1], b"".join(parts), ahead[-1] - second[-1])
        return found

    def search(self, section: str) -> list[tuple[float, bytes]]:
        """The n best paths, best first, by A* from the end: what a path scored plus the best score before it."""
        if section in self.paths:
            return self.paths[section]
        if len(self.paths) >= SECTIONS_KEPT:
            self.paths.clear()
        arcs, ahead = self.forward(section)
        ends: list[list[tuple[int, int, float, bytes]]] = [[] for _ in range(len(section) + 1)]
        for arc in arcs:
            ends[arc[1]].append(arc)
        # Of equal paths the one that got furthest goes on, so ties do not widen the search.
        heap, serial, found = [(-ahead[-1], len(section), 0, 0.0, None)], 0, []
        while heap and len(found) < self.n:
            _, at, _, done, path = heapq.heappop(heap)
            if at == 0:
                ids: list[bytes] = []
                while path is not None:
                    ids.append(path[0])
                    path = path[1]
                found.append((done, b"".join(ids)))
                continue
            for i, _, score, ids_ in ends[at]:
                serial += 1
                heapq.heappush(heap, (-(ahead[i] + score + done), i, serial, score + done, (ids_, path)))
        self.paths[section] = found
        return found

    def split(self, text: str) -> list[str | None]:
        """Sections of the text; None stands for a mark that the text itself has."""
        found: list[str | None] = []
        for k, part in enumerate(text.split(MARK)):
            found += [None] * (k > 0)
            found += self.sections.findall((MARK if k == 0 else "") + part.replace(" ", MARK))
        return found

    def encode(self, text: str) -> list[tuple[float, bytes]]:
        """The text's n best segmentations: n best choices of one path for each section."""
        if not text:
            return [(0.0, b"")]
        sections = self.split(text)
        mark, get = (self.whole_mark[0], packed_ids(self.whole_mark[1]), math.inf), self.first.get
        best = [get(s) or (mark if s is None else self.best(s)) for s in sections]
        scores, first, costs = zip(*best)
        total = sum(scores)
        # Only the n - 1 sections whose second path costs least can differ from the best in an n-best choice.
        chosen = heapq.nsmallest(self.n - 1, range(len(costs)), key=costs.__getitem__)
        choices: list[tuple[float, tuple[tuple[int, bytes], ...]]] = [(0.0, ())]
        for k in chosen:
            if costs[k] == math.inf:
                break
            paths = self.search(sections[k])
            more = [(lost + paths[0][0] - p[0], done + ((k, p[1]),) if r else done) for lost, done in choices for r, p in enumerate(paths)]
            choices = heapq.nsmallest(self.n, more, key=lambda c: c[0])
        out = []
        for lost, changes in choices:
            ids = first
            if changes:
                ids = list(first)
                for k, path in changes:
                    ids[k] = path
            out.append((total - lost, b"".join(ids)))
        return out

    def decode(self, ids: bytes) -> str:
        """The text: marks become spaces, the first is dropped, runs of bytes become characters."""
        out = bytearray()
        for i in np.frombuffer(ids, "<u4").tolist():
            byte = self.bytes_of_id.get(i)
            out += bytes([byte]) if byte is not None else self.names[i].replace(MARK, " ").encode()
        return bytes(out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")


def encoder(model, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(model.value, n)
        kind = pa.list_(pa.struct([("score", pa.float64()), ("n_pieces", pa.int64()), ("ids", pa.binary())]))

        def batch_of(ids, found):
            rows = [[{"score": s, "n_pieces": len(b) // 4, "ids": b} for s, b in f] for f in found]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, kind)], names=["doc_id", "nbest"])

        for batch in batches:
            ids, found, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                ids.append(doc_id)
                found.append(lattice.encode(text))
                size += len(text)
                if size >= BATCH_CHARS:
                    yield batch_of(ids, found)
                    ids, found, size = [], [], 0
            if ids:
                yield batch_of(ids, found)

    return run


def decoder(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(model.value, 1)
        for batch in batches:
            texts = [None if x is None else lattice.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def encode(docs: DataFrame, model: bytes, n: int = 1) -> DataFrame:
    """``doc_id, nbest`` of every row's whole text: up to ``n`` segmentations, the best first, with score, pieces and ids.

    Scores are sums of the model's piece scores. Characters that are no piece, and the
    mark itself, go as byte pieces with score 0, so decoding gives the text back. Equal
    scores come in a fixed order. A null text counts as empty, and an empty text has one
    segmentation without pieces. Rows are kept one for one, without doc_id too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(encoder(shared, n), ENCODED)


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids``; null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    return encoded.select("doc_id", "ids").mapInArrow(decoder(shared), "doc_id bigint, text string")
