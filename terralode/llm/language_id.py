"""Language identification by cross-parsing: the language whose training text covers a text in the fewest phrases.

For each language a suffix automaton of its training text is built once, on the
driver, from a bounded sample, and travels to the tasks as one sparse table of all
transitions, whose size follows the training text and not the alphabet.
A text is cut, from left to right, into the longest phrases that occur somewhere in
a language's training text; the number of phrases, times the bits that name a
place in that text, per character, is the cross-entropy. The lowest wins. Long
texts are parsed in blocks of ``block`` characters, each starting a new phrase, so
that a task follows many places at once.
"""

from __future__ import annotations

import math
import pickle
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from terralode.session import local_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOUND = "lang_pred string, score double, bits double"
GAP, OTHER = 0, 1  # classes of code points: what is no letter, and letters in no training text
CODE_POINTS = 0x110000


@dataclass
class Model:
    """``roots``, ``place_bits`` and moves from the root by language; all other moves by hashed state and class.

    ``keys`` holds ``state * width + class`` in the first free slot from its hash on, -1 where
    there is none, and ``targets`` the next state.
    """

    languages: list[str]
    classes: np.ndarray
    letters: np.ndarray
    width: int
    keys: np.ndarray
    targets: np.ndarray
    roots: np.ndarray
    place_bits: np.ndarray

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return slots_of(keys, len(self.keys))

    def move(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Next states, 0 for none."""
        wanted = states * np.int64(self.width) + symbols
        slot = self.slots(wanted)
        held = self.keys[slot]
        out = np.where(held == wanted, self.targets[slot], 0)
        left = np.nonzero((held != wanted) & (held != -1))
        while len(left[0]):
            slot[left] = (slot[left] + 1) % len(self.keys)
            held = self.keys[slot[left]]
            hit = held == wanted[left]
            out[tuple(x[hit] for x in left)] = self.targets[slot[tuple(x[hit] for x in left)]]
            on = ~hit & (held != -1)
            left = tuple(x[on] for x in left)
        return out


def slots_of(keys: np.ndarray, size: int) -> np.ndarray:
    """Where the search for a key begins in a table of a power of two slots."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def hashed(keys: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A table at most half full, by linear probing."""
    size = 1 << max(4, (2 * len(keys)).bit_length())
    table, values = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    slot, left = slots_of(keys, size), np.arange(len(keys))
    while len(left):
        # Of the keys that ask for one free slot the first gets it.
        asked, first = np.unique(slot[left], return_index=True)
        free = table[asked] == -1
        placed = left[first[free]]
        table[asked[free]], values[asked[free]] = keys[placed], targets[placed]
        rest = np.ones(len(left), bool)
        rest[first[free]] = False
        left = left[rest]
        slot[left] = (slot[left] + 1) % size
    return table, values


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def letter_table() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(CODE_POINTS)])


def class_table(texts: list[str], letters: np.ndarray) -> np.ndarray:
    """Class of each code point: every letter of the training texts has one, shared with its other case."""
    classes = np.where(letters, OTHER, GAP).astype(np.int32)
    seen = sorted({c.lower() for t in texts for c in set(t) if letters[ord(c)] and len(c.lower()) == 1})
    for i, c in enumerate(seen):
        classes[ord(c)] = i + 2
        if len(c.upper()) == 1:
            classes[ord(c.upper())] = i + 2
    return classes


def folded(text: str, classes: np.ndarray) -> np.ndarray:
    """The text's classes, runs of gaps drawn together."""
    found = classes[code_points(text)]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != GAP) | (found[:-1] != GAP)
    return found[keep]


def suffix_automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the root."""
    follow: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for symbol in symbols.tolist():
        state = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in follow[p]:
            follow[p][symbol] = state
            p = link[p]
        if p >= 0:
            q = follow[p][symbol]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(symbol) == q:
                    follow[p][symbol] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return follow


def fit(labelled: DataFrame, docs_per_language: int = 64, chars_per_language: int = 24_000, chars_in_all: int = 2_400_000) -> Model:
    """Learns from ``text`` and ``lang`` of the given rows, every language; null texts and languages teach nothing.

    The fit looks at a bounded sample: of each language ``docs_per_language`` documents by the
    order of a hash, or all if there are fewer, and ``chars_per_language`` characters of them
    in all, shared alike; of over 100 languages fewer each, so that there are no more than
    ``chars_in_all``. Of a long document the sample has four passages, spread from its
    beginning to its end. The model takes about 130 bytes a character, 300 MB at most, on
    the driver and in each task.
    """
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    chars = min(chars_per_language, max(1, chars_in_all // max(1, len(sizes))))
    shares = {lang: max(1, chars // min(n, docs_per_language)) for lang, n in sizes.items()}
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    ranked = rows.join(F.broadcast(local_rows(labelled.sparkSession, sorted(shares.items()), "lang string, share int")), "lang")
    sample = ranked.select("lang", "doc_id", passages("text", F.col("share") * 5 / 4).alias("text"))
    sample = sample.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= docs_per_language)
    texts: dict[str, list[str]] = {lang: [] for lang in sorted(sizes)}
    for r in sorted(sample.collect(), key=lambda r: (r.lang, r.rank)):
        texts[r.lang].append(r.text)
    letters = letter_table()
    classes = class_table([t for own in texts.values() for t in own], letters)
    width = int(classes.max()) + 1
    languages, roots, bits, at = [], [], [], 1
    moves: list[np.ndarray] = []
    for lang, own in texts.items():
        parts = [x for text in own for x in (folded(text, classes)[: shares[lang]], np.array([GAP], np.int32))]
        symbols = np.concatenate([*parts, np.empty(0, np.int32)])
        if not (symbols > OTHER).any():
            continue  # its texts have no letter, and no text with letters is like them
        follow = suffix_automaton(symbols)
        moves.append(np.array([((state + at) * width + c, target + at) for state, edges in enumerate(follow) for c, target in edges.items() if c != OTHER], np.int64).reshape(-1, 2))
        languages.append(lang)
        roots.append(at)
        bits.append(math.log2(len(symbols) + 1))
        at += len(follow)
    known = np.concatenate([*moves, np.empty((0, 2), np.int64)])
    keys, targets = hashed(known[:, 0], known[:, 1].astype(np.int32))
    return Model(languages, classes, letters, width, keys, targets, np.array(roots, np.int64), np.array(bits))


def passages(text: str, size: Column, pieces: int = 4) -> Column:
    """About ``size`` characters of a text: all, or pieces spread evenly over it."""
    piece = F.ceil(size / pieces).cast("int")
    room = F.char_length(text) - piece
    cut = [F.substring(F.col(text), (F.floor(room * i / (pieces - 1)) + 1).cast("int"), piece) for i in range(pieces)]
    return F.when(F.char_length(text) <= size, F.col(text)).otherwise(F.concat_ws("\n", *cut))


def parse(blocks: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Phrases by block and language. ``blocks``: classes, one block a row, longest first."""
    roots = model.roots
    # From the root, by class in these blocks and language.
    found, place = np.unique(blocks, return_inverse=True)
    blocks = place.reshape(blocks.shape)
    start = model.move(np.broadcast_to(roots, (len(found), len(roots))), found.astype(np.int64)[:, None])
    start = np.where(start == 0, roots, start)
    state = np.repeat(roots[None, :], len(blocks), axis=0)
    phrases = np.ones(state.shape, np.int32)
    alive = np.searchsorted(-lengths, -np.arange(blocks.shape[1]), side="left")
    for i in range(blocks.shape[1]):
        n = alive[i]
        symbol = blocks[:n, i]
        after = model.move(state[:n], found[symbol].astype(np.int64)[:, None])
        ended = after == 0
        if i:
            phrases[:n] += ended
        state[:n] = np.where(ended, start[symbol], after)
    return phrases


def predictor(model, block: int, batch_chars: int, at: int, n_out: int):
    """A task's function: the first ``n_out`` columns, and what is found for the text in column ``at``."""

    def predict(m: Model, rows: pa.RecordBatch, texts: list[str | None]) -> pa.RecordBatch:
        n_lang = len(m.languages)
        own = [folded(t or "", m.classes) for t in texts]
        has_letter = [bool(t) and bool(m.letters[code_points(t)].any()) for t in texts]
        sizes = np.array([len(x) for x in own])
        n_blocks = -(-sizes // block)
        doc = np.repeat(np.arange(len(own)), n_blocks)
        flat = np.concatenate([*own, np.zeros(block, np.int32)])
        offset = np.arange(len(doc)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        begin = np.repeat(np.cumsum(sizes) - sizes, n_blocks) + offset * block
        lengths = np.minimum(block, sizes[doc] - offset * block)
        order = np.argsort(-lengths, kind="stable")
        phrases = np.zeros((len(own), n_lang))
        for part in np.array_split(order, max(1, len(order) * block // batch_chars)):
            if len(part) and n_lang:
                grid = flat[begin[part][:, None] + np.arange(int(lengths[part[0]]))]
                np.add.at(phrases, doc[part], parse(grid, lengths[part], m))
        bits = phrases * m.place_bits / np.maximum(1, sizes)[:, None]
        langs, scores, best_bits = [], [], []
        for i, letter in enumerate(has_letter):
            if not letter or not n_lang:
                langs.append("und")
                scores.append(0.0)
                best_bits.append(None)
                continue
            ranked = np.argsort(bits[i], kind="stable")
            best = bits[i][ranked[0]]
            other = bits[i][ranked[1]] if n_lang > 1 else 2 * best
            langs.append(m.languages[ranked[0]])
            scores.append(float(1 - best / other) if other > 0 else 0.0)
            best_bits.append(float(best))
        return pa.RecordBatch.from_arrays(
            [*rows.columns[:n_out], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(best_bits, pa.float64())],
            names=[*rows.schema.names[:n_out], "lang_pred", "score", "bits"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pickle.loads(model.value)
        for batch in batches:
            begin, texts, size = 0, [], 0
            for r, text in enumerate(batch.column(at)):
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= batch_chars or r == batch.num_rows - 1:
                    yield predict(held, batch.slice(begin, len(texts)), texts)
                    begin, texts, size = r + 1, [], 0

    return run


def identify(docs: DataFrame, model: Model, keep: list[str], block: int = 256, batch_chars: int = 4_000_000) -> DataFrame:
    """The columns ``keep`` of every row, and ``lang_pred, score, bits`` of its whole text; no other column is looked at.

    ``score``, from 0 to 1, is how much fewer bits the best language needs than the next
    best; ``bits`` is what it needs per character. A null text, or one without any letter,
    is ``und`` with score 0 and null bits; so is every text if nothing was learnt. Of
    languages that need the same, the first by name wins. Rows are kept one for one; an
    empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    asked = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("text_"))
    schema = T.StructType([*asked.schema.fields[:-1], *T.StructType.fromDDL(FOUND).fields])
    return asked.mapInArrow(predictor(shared, block, batch_chars, len(keep), len(keep)), schema)
