"""Spelling variants by reduced-alphabet neighbourhoods.

Letters are hashed to a few symbols, whose number follows the size of the vocabulary. One
edit of a word is at most one edit of its reduced word, so every word's reduced word and all
its one-edit neighbours (deletions, replacements, insertions over the few symbols) are
generated and joined with the vocabulary by reduced word; the original words then prove
whether they are one edit apart. Each word finds all its partners that way, with nothing
collected: pairs that fail the proof never leave the join.

Neighbours that no word reduces to are left out before the join by a bit table of the
reduced vocabulary, of a fixed largest size; it only saves work.

All joins are merge joins by hint. Spark would size their tables by compressed files, and the
neighbours as if each word stayed one row, and so broadcast what the driver cannot hold.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from terralode.llm.common import saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN_PATTERN = "[A-Za-zÀ-ÿ]+"
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
# Words a task counts before it hands its counts on.
COUNTED_AT_ONCE = 400_000

# Reduced words are told by a polynomial over 64 bits; the base is odd, so it can be divided by.
MOD = 1 << 64
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, MOD)
FEWEST_SYMBOLS, MOST_SYMBOLS = 4, 32
# Letters of words whose neighbours are made at once.
LETTERS_AT_ONCE = 1 << 16

# The bit table: some bits for each reduced word, at most 32 MB of them.
BITS_A_WORD = 64
FEWEST_BITS, MOST_BITS = 1 << 15, 1 << 28


def word_counter(least_length: int, damage: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(RUN_PATTERN)
        counts: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                found = Counter(runs.findall(text.translate(ASCII_LOWER)))
                if damage:
                    head = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                    for word, n in found.items():
                        h = zlib.crc32(word.encode(), head)
                        if h % 97 == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        if len(word) >= least_length:
                            counts[word] += n
                else:
                    for word, n in found.items():
                        if len(word) >= least_length:
                            counts[word] += n
                if len(counts) >= COUNTED_AT_ONCE:
                    yield counted()
                    counts.clear()
        if counts:
            yield counted()

    return run


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, damage: bool = False) -> DataFrame:
    """``word, n`` of the runs of letters of all texts, A-Z lower-cased, with so many code points and occurrences.

    Letters are A-Z, a-z and code points C0 to FF. With ``damage`` a run loses one code point
    where the checksum of ``doc_id:run`` is divisible by 97, at that checksum modulo its
    length; a null doc_id is empty there. A null text has no words. No texts, no words.
    """
    rows = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    counts = rows.mapInArrow(word_counter(least_length, damage), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def symbols_for(words: int) -> int:
    """So many symbols that six of them tell as many words apart as there are."""
    return next((s for s in range(FEWEST_SYMBOLS, MOST_SYMBOLS) if s**6 >= words), MOST_SYMBOLS)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(codes: np.ndarray) -> np.ndarray:
    """Codes spread over all bits, one to one."""
    codes = codes ^ (codes >> np.uint64(32))
    codes = codes * np.uint64(0xD6E8FEB86659FD93)
    return codes ^ (codes >> np.uint64(32))


def reduced(word: str, symbols: int) -> np.ndarray:
    """A word's symbols, from 1 on: each letter goes to one by a hash of its code point."""
    letters = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
    letters = letters * np.uint64(0xFF51AFD7ED558CCD)
    return (letters >> np.uint64(40)) % np.uint64(symbols) + np.uint64(1)


def code_of(grid: np.ndarray) -> np.ndarray:
    """Codes of reduced words of one length, a row each."""
    return (grid * powers(grid.shape[1])).sum(axis=1, dtype=np.uint64)


def coder(symbols: int):
    """Adds the code of each word's reduced word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            codes = np.zeros(len(words), np.uint64)
            for places, grid in by_length(words, symbols):
                codes[places] = mixed(code_of(grid))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes.view(np.int64), pa.int64())], names=["word", "n", "code"])

    return run


def by_length(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and reduced words of words of one length, not too many letters at a time."""
    groups: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        groups.setdefault(len(word), []).append(at)
    for length, places in sorted(groups.items()):
        step = max(1, LETTERS_AT_ONCE // max(length, 1))
        for first in range(0, len(places), step):
            some = places[first : first + step]
            letters = reduced("".join(words[p] for p in some), symbols)
            yield np.array(some), letters.reshape(len(some), length)


def neighbour_blocks(grid: np.ndarray, symbols: int, positions: int = LETTERS_AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and codes of all reduced words within one edit of each row's, that row's own among them, each once.

    Of edits with equal results one is made: of a run of equal symbols the first is deleted,
    and none is inserted behind its equal.
    """
    n, length = grid.shape
    power = powers(length + 1)
    terms = grid * power[:length]
    before = np.zeros((n, length + 1), np.uint64)  # the code of what stands before each place
    np.cumsum(terms, axis=1, dtype=np.uint64, out=before[:, 1:])
    whole = before[:, -1:]
    yield np.arange(n), whole[:, 0]
    for first in range(0, length + 1, positions):
        at = slice(first, min(first + positions, length + 1))
        here = slice(first, min(first + positions, length))
        after = whole - before[:, at]
        left = np.zeros((n, at.stop - at.start), np.uint64)  # the symbol before each place, 0 at the start
        left[:, max(1 - first, 0) :] = grid[:, max(first - 1, 0) : at.stop - 1]
        width = here.stop - here.start
        kept = before[:, here] + (whole - before[:, first + 1 : here.stop + 1]) * np.uint64(BASE_INVERSE)
        row, place = np.nonzero(grid[:, here] != left[:, :width])
        yield row, kept[row, place]
        for symbol in range(1, symbols + 1):
            row, place = np.nonzero(grid[:, here] != symbol)
            yield row, (whole + (np.uint64(symbol) - grid[:, here]) * power[here])[row, place]
            row, place = np.nonzero(left != symbol)
            yield row, (before[:, at] + np.uint64(symbol) * power[at] + after * np.uint64(BASE))[row, place]


def in_table(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = codes & np.uint64(len(bits) * 8 - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def neighbour_maker(symbols: int, table):
    """Rows ``code, word, n``: each word under all codes within one edit of its own that the vocabulary may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, np.uint8)
        for batch in batches:
            words = batch.column(0).to_pylist()
            for places, grid in by_length(words, symbols):
                rows, codes = [], []
                for row, code in neighbour_blocks(grid, symbols):
                    code = mixed(code)
                    held = in_table(code, bits)
                    rows.append(row[held])
                    codes.append(code[held])
                row, code = np.concatenate(rows), np.concatenate(codes)
                taken = pa.array(places[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code.view(np.int64)), batch.column(0).take(taken), batch.column(1).take(taken)], names=["code", "word", "n"]
                )

    return run


def bit_table(coded: DataFrame, words: int) -> bytearray:
    """Which low bits of a code some word has; at most ``MOST_BITS`` bits, whatever the vocabulary."""
    bits = min(max(1 << (BITS_A_WORD * max(words, 1) - 1).bit_length(), FEWEST_BITS), MOST_BITS)
    # Buckets of 32768 bits, combined before they are shuffled, each 4 KB.
    place = F.col("code").bitwiseAND(bits - 1).alias("place")
    buckets = (
        coded.select(place)
        .groupBy(F.shiftright("place", 15).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(FEWEST_BITS - 1)).alias("bits"))
    )
    out = bytearray(bits // 8)
    for row in buckets.toLocalIterator():
        at = row["bucket"] * (FEWEST_BITS // 8)
        out[at : at + len(row["bits"])] = row["bits"]
    return out


def near_words(words: DataFrame, n_words: int, symbols: int | None = None) -> DataFrame:
    """``word, n, near, near_n`` of all pairs of words that differ by exactly one code point inserted, deleted or replaced, both ways.

    ``words`` has distinct ``word, n``.
    """
    symbols = symbols or symbols_for(n_words)
    coded = saved(words.select("word", "n").mapInArrow(coder(symbols), "word string, n bigint, code bigint"), "coded")
    table = words.sparkSession.sparkContext.broadcast(bytes(bit_table(coded, n_words)))
    around = coded.select("word", "n").mapInArrow(neighbour_maker(symbols, table), "code bigint, word string, n bigint")
    held = coded.select("code", F.col("word").alias("near"), F.col("n").alias("near_n"))
    sized = F.abs(F.char_length("word") - F.char_length("near")) <= 1
    one_edit = F.levenshtein("word", "near", 1) == 1
    return around.join(held.hint("merge"), "code").where(sized & one_edit).select("word", "n", "near", "near_n")


def roots(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``word, root`` of rows ``word, form``: where following the forms ends.

    Ways double each round. A form has at least twice its word's count, so a way is as
    long as the count's logarithm at most, and the rounds are few.
    """
    ways = saved(forms.select("word", F.col("form").alias("root")), "ways")
    for _ in range(max_rounds):
        there = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        followed = ways.join(there.hint("merge"), "root", "left")
        moved = saved(followed.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "ways")
        ways = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return ways
    raise RuntimeError(f"forms did not settle in {max_rounds} rounds")


def group_variants(words: DataFrame, times: int = 2, symbols: int | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``words``, distinct ``word, n``.

    Words are near if exactly one code point is inserted, deleted or replaced. A word's form is
    its near word of the largest count, of equal ones the least by code points, if that count is
    at least ``times`` its own; else null. ``root`` is the last word reached by forms, the word
    itself if it has none. ``n_near`` counts near words, 0 if there are none; ``form_n`` is the form's
    count or null. An empty table gives no rows. ``times`` is 2 or more.
    """
    words = saved(words.select("word", "n"), "words")
    pairs = near_words(words, words.count(), symbols)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))).alias("best")
    found = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best, F.first("n").alias("n"))
    found = saved(
        found.select("word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.form").alias("near"), (-F.col("best.minus") >= times * F.col("n")).alias("follows")), "found"
    )
    forms = found.where("follows").select("word", F.col("near").alias("form"), F.col("near_n").alias("form_n"))
    last = roots(forms)
    near = found.select("word", "n_near")
    return (
        words.join(near.hint("merge"), "word", "left")
        .join(forms.hint("merge"), "word", "left")
        .join(last.hint("merge"), "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")
    )
