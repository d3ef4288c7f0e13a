"""Benchmark decontamination by a generalised suffix automaton of the test items' words.

The items' words make one automaton that knows every run of words of every item. A
document's words are streamed through it; the longest run that ends at each word and
stands in some item is tracked, and where it reaches a window's length a window of an
item ends. A task holds one automaton and one document; documents are not shuffled.

The items are collected to the driver in blocks of about ``BLOCK_WORDS`` words, an
automaton and a pass over the documents for each; what several passes find meets by document.
"""

from __future__ import annotations

import itertools
import pickle
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.llm.common import saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words of an automaton: bounds what the driver collects and each task holds (about 40 MB).
BLOCK_WORDS = 200_000
# A longer item comes in pieces of so many words, each holding the end of the one before.
PIECE_WORDS = 4096

# Bytes of words: digits, letters and everything beyond ASCII; A-Z are lower-cased, the rest parts words.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SPANS = "array<struct<start: bigint, length: bigint>>"
FOUND = f"n_words bigint, spans {SPANS}, items array<string>"
FOUND_TYPES = (
    pa.int64(),
    pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])),
    pa.list_(pa.string()),
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class Automaton:
    """Suffix automaton of word sequences, with the windows of ``window`` words and the shorter items marked.

    States are numbered from the root, 0; the move of state ``v`` by word number ``c``
    is ``moves[v * n_words + c]``.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        for _, words in items:
            for word in words:
                self.numbers.setdefault(word, len(self.numbers))
        sequences = [(item, [self.numbers[w] for w in words]) for item, words in items]
        edges: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, sequence in sequences:
            last = 0
            for c in sequence:
                last = self._extend(edges, last, c)
        width = max(len(self.numbers), 1)
        self.moves = {v * width + c: t for v, out in enumerate(edges) for c, t in out.items()}
        self.link[0] = 0
        # The state of the last ``window`` words of a run, for states of at least as many.
        self.ends = [-1] * len(edges)
        for v in sorted(range(len(edges)), key=self.length.__getitem__):
            if self.length[v] >= window:
                up = self.link[v]
                self.ends[v] = v if self.length[up] < window else self.ends[up]
        self.items: dict[int, set[str]] = {}
        whole: dict[int, list[tuple[int, str | None]]] = {}
        for item, sequence in sequences:
            v = 0
            for at, c in enumerate(sequence, 1):
                v = self.moves[v * width + c]
                if at >= window:
                    self.items.setdefault(self.ends[v], set()).add(item)
            if 0 < len(sequence) < window:
                whole.setdefault(v, []).append((len(sequence), item))
        self.whole = {v: sorted(set(found), key=repr) for v, found in whole.items()}
        # The nearest state on the way to the root that is a whole short item.
        self.short = [-1] * len(edges)
        for v in sorted(range(1, len(edges)), key=self.length.__getitem__):
            self.short[v] = v if v in self.whole else self.short[self.link[v]]
        self.least = min([window, *(n for found in self.whole.values() for n, _ in found)])

    def _extend(self, edges: list[dict[int, int]], last: int, c: int) -> int:
        """The state of the sequence read so far with ``c`` after it; earlier items may have made it."""
        link, length = self.link, self.length
        if c in edges[last]:
            there = edges[last][c]
            return there if length[there] == length[last] + 1 else self._split(edges, last, c, there)
        new = self._state(edges, {}, length[last] + 1)
        p = last
        while p != -1 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p == -1:
            link[new] = 0
        else:
            there = edges[p][c]
            link[new] = there if length[there] == length[p] + 1 else self._split(edges, p, c, there)
        return new

    def _state(self, edges: list[dict[int, int]], out: dict[int, int], length: int) -> int:
        edges.append(out)
        self.length.append(length)
        self.link.append(0)
        return len(edges) - 1

    def _split(self, edges: list[dict[int, int]], p: int, c: int, there: int) -> int:
        """A state of its own for the shorter runs of ``there``."""
        copy = self._state(edges, dict(edges[there]), self.length[p] + 1)
        self.link[copy], self.link[there] = self.link[there], copy
        while p != -1 and edges[p].get(c) == there:
            edges[p][c] = copy
            p = self.link[p]
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans ``start, length`` of words in some window's occurrence, in order, and the items with one."""
        if len(words) < self.least or not self.numbers:
            return [], set()
        numbers = np.fromiter(map(self.numbers.get, words, itertools.repeat(-1)), np.int64, len(words))
        spans: list[list[int]] = []
        hit: set[int] = set()
        shorts: set[str | None] = set()
        # A run of item words that is too short holds no window.
        known = np.flatnonzero(np.diff(np.concatenate(([0], numbers >= 0, [0]))))
        for start, stop in known.reshape(-1, 2)[np.diff(known)[::2] >= self.least].tolist():
            self._scan_run(numbers[start:stop].tolist(), start, spans, hit, shorts)
        found = set().union(*(self.items[v] for v in hit), shorts)
        return [(s, e - s) for s, e in spans], found - {None}

    def _scan_run(self, numbers: list[int], offset: int, spans: list[list[int]], hit: set[int], shorts: set[str | None]) -> None:
        moves, link, length, width, least = self.moves.get, self.link, self.length, len(self.numbers), self.least
        v = longest = 0
        for at, c in enumerate(numbers, offset + 1):
            there = moves(v * width + c)
            if there is None:
                while there is None:  # the root has a move for every word of an item
                    v = link[v]
                    there = moves(v * width + c)
                longest = length[v] + 1
            else:
                longest += 1
            v = there
            if longest < least:
                continue
            size = 0
            if longest >= self.window:
                size = self.window
                hit.add(self.ends[v])
            up = self.short[v]
            while up > 0:
                for n, item in self.whole[up]:
                    if n <= longest:
                        shorts.add(item)
                        size = max(size, n)
                up = self.short[link[up]]
            if size:
                begin = at - size
                while spans and begin <= spans[-1][1]:
                    begin = min(begin, spans.pop()[0])
                spans.append([begin, at])


def shared(spark: SparkSession, automaton: Automaton):
    """The automaton as bytes that carry its class along: executors need not have the library."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(automaton))


def scanner(automaton):
    """Adds what the automaton finds in the text, the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Automaton = pickle.loads(automaton.value)
        for batch in batches:
            sizes, spans, items = [], [], []
            for text in batch.column(batch.num_columns - 1):
                words = words_of(text.as_py())
                here, found = held.scan(words)
                sizes.append(len(words))
                spans.append([{"start": s, "length": n} for s, n in here])
                items.append(sorted(found))
            columns = [pa.array(values, kind) for values, kind in zip((sizes, spans, items), FOUND_TYPES)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "n_words", "spans", "items"])

    return run


def piece_cutter(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                for at in range(0, max(len(words) - window + 1, min(len(words), 1)), PIECE_WORDS - window + 1):
                    piece = words[at : at + PIECE_WORDS]
                    rows.append((item, len(piece), b" ".join(piece)))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((), (), ()), (pa.string(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "n", "piece"])

    return run


def automata(items: DataFrame, window: int, block_words: int = BLOCK_WORDS) -> Iterator[Automaton]:
    """The automata of ``item_id, text`` rows, one of about ``block_words`` words after the other."""
    texts = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    pieces = saved(texts.mapInArrow(piece_cutter(window), "item string, n bigint, piece binary").distinct(), "pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // block_words)
    for block in range(blocks):
        rows = pieces.where(F.pmod(F.xxhash64("item", "piece"), F.lit(blocks)) == block).select("item", "piece").collect()
        yield Automaton(sorted(((r["item"], bytes(r["piece"]).split(b" ")) for r in rows), key=repr), window)


def merged(spans: list[dict]) -> list[dict]:
    """Spans that touch made one."""
    out: list[list[int]] = []
    for s, e in sorted((x["start"], x["start"] + x["length"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [{"start": s, "length": e - s} for s, e in out]


def span_merger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("spans")
        yield batch.set_column(at, batch.schema.field(at), pa.array([merged(x) for x in batch.column(at).to_pylist()], FOUND_TYPES[1]))


def find_leaks(docs: DataFrame, items: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS, keep_text: bool = False) -> DataFrame:
    """``doc_id, n_words, spans, items`` (and ``text``) of every row of ``docs``.

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. A window is
    ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window. ``spans`` are the maximal runs of document words inside occurrences of windows, as
    first word (from 0) and number of words; ``items`` are the ids, as strings, sorted and
    distinct, of the items with such windows.
    A null text has no words. Items without words, or null ones, are no windows; those of one
    id are one item; one without item_id marks words but is not listed. Rows are kept one for
    one, without doc_id and repeated ones too. No items: nothing is found. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    columns = ["doc_id", *(["text"] if keep_text else []), "n_words", "spans", "items"]
    passes = []
    for automaton in automata(items, window, block_words):
        passes.append(rows.mapInArrow(scanner(shared(spark, automaton)), f"doc_id bigint, text string, {FOUND}"))
    if len(passes) == 1:
        return passes[0].select(columns)
    if not passes:
        nothing = scanner(shared(spark, Automaton([], window)))
        return rows.mapInArrow(nothing, f"doc_id bigint, text string, {FOUND}").select(columns)
    # Rows of one id and text find the same; each pass gives only documents with hits.
    key = ["doc_id", "text_hash"]
    hash_ = F.xxhash64("text").alias("text_hash")
    each = [p.where("size(spans) > 0").select("doc_id", hash_, "spans", "items").distinct() for p in passes]
    hits = reduce(DataFrame.union, [saved(e, "hits") for e in each]).groupBy(*key).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = hits.select("doc_id", "text_hash", "spans", "items").mapInArrow(span_merger, f"doc_id bigint, text_hash bigint, spans {SPANS}, items array<string>")
    found = passes[0].select("doc_id", "text", hash_, "n_words").alias("a").join(
        hits.alias("h"), F.col("a.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("a.text_hash") == F.col("h.text_hash")), "left"
    )
    return found.select(
        F.col("a.doc_id").alias("doc_id"),
        "text",
        "n_words",
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ).select(columns)


def text_cutter(max_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py()
                spans = [(x["start"], x["start"] + x["length"]) for x in spans if x["length"] > max_words]
                if text is not None and spans:
                    data = text.encode()
                    is_word = np.frombuffer(data.translate(WORD_BYTES), np.uint8) != 32
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], is_word, [0])))).reshape(-1, 2)
                    cuts = [0, *(place for s, e in spans for place in (edges[s][0], edges[e - 1][1])), len(data)]
                    text = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2])).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "kept_text"])

    return run


def remove_leaks(found: DataFrame, max_span: int = 0, max_coverage: float = 1.0) -> DataFrame:
    """Rows of ``find_leaks`` with texts, the leaks cut out: ``kept_text`` lacks the spans of over ``max_span`` words.

    A row whose spans hold over ``max_coverage`` of its words goes. What stands between
    the words of a span goes with it. A null text stays null.
    """
    covered = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["length"])
    kept = found.where(covered <= max_coverage * F.col("n_words")).select("doc_id", "text", "spans", "n_words", "items")
    return kept.mapInArrow(text_cutter(max_span), f"doc_id bigint, text string, spans {SPANS}, n_words bigint, items array<string>, kept_text string")


def digest(found: DataFrame) -> DataFrame:
    """Counts and the checksum of the items' ids, joined by commas."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["length"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
