"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the shingles' hashes make a whole signature: the first spreads
them, the second ranks them, and shifting its argument by k gives coordinate k.
Documents of the same shingle set are one class with one representative; only
representatives are compared. In each bucket members are first compared with the
bucket's smallest one, and what is then known to be connected is not compared again,
so a large group of near copies costs a few comparisons a member. In buckets whose
members are still in different components all are then compared inside the tasks, block
by block, and only what connects them is written out.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from terralode.llm.common import saved
from terralode.llm.components import connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIGNED = "doc_id bigint, text_hash bigint, n_shingles bigint, set_key binary, buckets array<bigint>"
MIX = np.uint64(0x9E3779B97F4A7C15)
WHOLE = np.uint64(0xD6E8FEB86659FD93)
WORDS_KEPT = 1 << 20
# Parts that members are dealt into where they are joined with their bucket: so many while
# its size is not known, then one for so many members.
SALTS = 8
DEALT_ROWS = 1024


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; with fewer words, of the whole sequence as one."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z only, and exactly the six ASCII blanks
    if not words:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    short = len(words) < width
    size = len(words) if short else width
    found = values[: len(values) - size + 1].copy()
    if short:
        found *= WHOLE
    for i in range(1, size):
        found ^= found >> np.uint64(32)
        found *= MIX
        found += values[i : len(values) - size + 1 + i]
    found ^= found >> np.uint64(29)
    found *= MIX
    found ^= found >> np.uint64(32)
    return np.unique(found)


def signature(found: np.ndarray, size: int) -> np.ndarray:
    """Smallest ranks of a set under the second permutation shifted by 0 to ``size`` - 1."""
    spread = (found >> np.uint64(32)).astype(np.uint32)
    spread *= np.uint32(0x85EBCA6B)
    spread ^= spread >> np.uint32(15)
    spread *= np.uint32(0x2C1B3C6D)
    spread ^= spread >> np.uint32(12)
    shift = np.arange(size, dtype=np.uint32)[:, None]
    lowest = np.full(size, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(spread), 2048):
        rank = spread[None, at : at + 2048] + shift
        rank ^= rank >> np.uint32(16)
        rank *= np.uint32(0x7FEB352D)
        rank ^= rank >> np.uint32(15)
        rank *= np.uint32(0x846CA68B)
        rank ^= rank >> np.uint32(16)
        np.minimum(lowest, rank.min(axis=1), out=lowest)
    return lowest


def band_keys(lowest: np.ndarray, bands: int) -> np.ndarray:
    grid = lowest.reshape(bands, -1).astype(np.uint64)
    keys = np.arange(1, bands + 1, dtype=np.uint64) * WHOLE
    for column in grid.T:
        keys ^= keys >> np.uint64(31)
        keys = (keys + column) * MIX
    keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def signer(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, keys, buckets = [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py(), width, hashes)
                sizes.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                buckets.append(band_keys(signature(found, bands * rows), bands) if len(found) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "set_key", "buckets"],
            )

    return run


def verifier(width: int, percent: int):
    """Pairs whose full sets are similar enough, of rows ``a, b, text_a, text_b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, last_set = WordHashes(), None, None
        for batch in batches:
            linked = []
            for a, text_a, text_b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != last:
                    last, last_set = a, shingles(text_a.as_py(), width, hashes)
                other = shingles(text_b.as_py(), width, hashes)
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                linked.append(100 * both >= percent * (len(last_set) + len(other) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def set_lister(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t.as_py(), width, hashes).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "set"])

    return run


def shared_shingles(sets: list[np.ndarray], others: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of all of ``sets`` with all of ``others``, by products of their incidence matrices."""
    left, right = np.concatenate(sets), np.concatenate(others)
    common = np.intersect1d(left, right)
    total = np.zeros((len(sets), len(others)), np.int64)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (sets, others)]
    for at in range(0, len(common), width):
        part = common[at : at + width]
        grids = []
        for values, row, count in ((left, rows[0], len(sets)), (right, rows[1], len(others))):
            place = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[place] == values
            grid = np.zeros((count, len(part)), np.float32)
            grid[row[hit], place[hit]] = 1
            grids.append(grid)
        total += (grids[0] @ grids[1].T).astype(np.int64)
    return total


def bucket_comparer(percent: int, tile: int = 256):
    """All members of a bucket's two blocks against each other, in the task: each member's smallest one reachable here."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, component = (table.column(c).to_numpy() for c in ("id", "component"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        sizes, root = np.array([len(x) for x in sets]), np.arange(len(ids))
        for a in range(0, len(ids), tile):
            for b in range(a, len(ids), tile):
                if (component[a : a + tile] == component[a]).all() and (component[b : b + tile] == component[a]).all():
                    continue
                both = shared_shingles(sets[a : a + tile], sets[b : b + tile])
                union = sizes[a : a + tile, None] + sizes[None, b : b + tile] - both
                i, j = np.nonzero(100 * both >= percent * union)
                i, j = i + a, j + b
                while len(i):
                    low = np.minimum(root[i], root[j])
                    if (root[i] == low).all() and (root[j] == low).all():
                        break
                    np.minimum.at(root, i, low)
                    np.minimum.at(root, j, low)
                    root = root[root]
        moved = root != np.arange(len(ids))
        return pa.table({"a": ids[root[moved]], "b": ids[moved]})

    return compare


def by_bucket(members: DataFrame, told: DataFrame) -> DataFrame:
    """Members with what is told of their bucket; those of a large one are dealt over several tasks."""
    parts = lambda size: F.ceil(size / DEALT_ROWS).cast("int")
    dealt = members.withColumn("part", F.pmod(F.xxhash64("id"), parts(F.col("size"))).cast("int"))
    copied = told.withColumn("part", F.explode(F.sequence(F.lit(0), parts(F.col("size")) - 1)))
    return dealt.join(copied.drop("size"), ["bucket", "part"]).drop("part")


def compare_buckets(members: DataFrame, sets: DataFrame, percent: int, block_rows: int = 1024, block_bytes: int = 1 << 25) -> DataFrame:
    """Links ``a, b`` that connect what is alike in the given buckets; a large bucket is cut into blocks, a task for each two.

    A block has about ``block_rows`` members whose sets come to ``block_bytes``, or fewer of either.
    """
    held = members.groupBy("bucket").agg(F.first("size").alias("size"), F.count("*").alias("open"), F.sum(8 * F.col("n")).alias("bytes"))
    held = held.withColumn("blocks", F.ceil(F.greatest(F.col("open") / block_rows, F.col("bytes") / block_bytes)).cast("int")).drop("open", "bytes")
    blocks = F.col("blocks")
    dealt = (
        by_bucket(members, held)
        .withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("bucket", F.least("block", "other").alias("b0"), F.greatest("block", "other").alias("b1"), "id", "component")
    )
    return dealt.join(sets, "id").groupBy("bucket", "b0", "b1").applyInArrow(bucket_comparer(percent), "a bigint, b bigint")


def sizes_fit(a: Column, b: Column, percent: int) -> Column:
    """Without this no intersection is large enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 24, rows: int = 5, star_rounds: int = 2) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Words are lower-cased (A-Z) and split at ASCII blanks; a document's set has its
    distinct runs of ``width`` words. Documents whose sets have a Jaccard similarity
    of ``percent`` hundredths or more are linked if they share one of ``bands``
    buckets of ``rows`` coordinates; every link is confirmed on the full sets.
    ``component_id`` is the smallest doc_id reachable, ``kept`` marks that document.
    A null or blank text has an empty set and is linked with nothing, and kept. A row
    without doc_id is linked with nothing and kept, its component null. Links are
    between shingle sets: rows of one doc_id with differing texts are each linked by
    their own, and rows of one doc_id and text are one document. An empty table gives no rows.
    """
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    signed = saved(texts.mapInArrow(signer(width, bands, rows), SIGNED), "signatures")
    classes = (
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "text_hash", "n_shingles", "buckets")).alias("r"))
        .select("set_key", F.monotonically_increasing_id().alias("id"), "r.doc_id", "r.text_hash", F.col("r.n_shingles").alias("n"), "r.buckets")
    )
    # A class has a number of its own, fixed by being written: a doc_id may stand for several sets.
    classes = saved(classes, "classes")
    placed = classes.select("id", "n", "doc_id", "text_hash", F.explode("buckets").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = shared.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    placed = saved(placed.join(shared, ["bucket", "part"]).drop("part"), "buckets")
    wanted = placed.select("id", "doc_id", "text_hash").distinct()
    wanted_texts = texts.join(wanted, ["doc_id", "text_hash"]).select("id", "text").dropDuplicates(["id"])
    wanted_texts = saved(wanted_texts, "candidates")

    def confirm(pairs: DataFrame) -> DataFrame:
        with_b = pairs.join(wanted_texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        with_a = with_b.join(wanted_texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        return with_a.select("a", "b", "text_a", "text_b").mapInArrow(verifier(width, percent), "a bigint, b bigint")

    members = placed.select("bucket", "size", "id", "n").withColumn("component", F.col("id"))
    tested = found = None
    for step in range(star_rounds + 1):
        # Only buckets with members that are not connected yet.
        open_ = members.groupBy("bucket").agg(F.first("size").alias("size"), F.min("component").alias("c0"), F.max("component").alias("c1"), F.min(F.struct("id", "n", "component")).alias("m")).where("c0 <> c1")
        if step < star_rounds:  # one comparison a member, with the smallest first member of its open buckets
            pairs = by_bucket(members, open_.select("bucket", "size", "m")).where("component <> m.component")
            pairs = pairs.where(sizes_fit(F.col("m.n"), F.col("n"), percent)).select(F.col("m.id").alias("a"), F.col("id").alias("b"))
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = saved(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs")
            tested = pairs if tested is None else tested.union(pairs)
            new = confirm(pairs)
        else:
            rest = saved(by_bucket(members, open_.select("bucket", "size")), "open")
            sets = wanted_texts.join(rest.select("id").distinct(), "id").mapInArrow(set_lister(width), "id bigint, set binary")
            new = compare_buckets(rest, sets, percent)
        links = saved(new if found is None else found.select(F.col("id").alias("a"), F.col("component").alias("b")).union(new), "confirmed")
        found = connected_components(links)
        if step == star_rounds:
            break
        label = found.withColumnRenamed("component", "label")
        members = saved(
            placed.select("bucket", "size", "id", "n").join(label, "id", "left").select("bucket", "size", "id", "n", F.coalesce("label", "id").alias("component")), "members"
        )
    # A component is told by its least doc_id: combined before it is shuffled, and dealt back in parts.
    linked = found.join(classes.select("id", "doc_id"), "id")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    least = least.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    told = found.withColumn("part", F.pmod("id", F.lit(SALTS)).cast("int")).join(least, ["component", "part"]).select("id", "component_id")
    named = classes.select("set_key", "id", "doc_id").join(told, "id", "left").select("set_key", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    own = F.coalesce("component_id", "doc_id")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(own)
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"))
