"""Each operator against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import collections
import glob
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terralode.llm import (
    byte_bpe,
    circulant_minhash,
    common,
    language_id,
    packing,
    piece_lattice,
    projection_forest,
    queries,
    rule_quality,
    simhash,
    suffix_dedup,
    token_counts,
    url_filters,
)
from terralode.llm.common import saved
from terralode.llm.components import connected_components

SPEC = byte_bpe.read_spec(public_tokenizers.path("byte_bpe_50k.json"))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, ids string"
PASSAGE = "a passage of well over a hundred bytes that stands in several documents, word for word, and so is found again "


def rows_of(texts):
    return [(i, t, None, None, None, None, "x") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 7))) for _ in range(400)]
    made = [" ".join(rng.choice(words, rng.integers(1, 160))) for _ in range(40)]
    near = made[3].split()
    near[len(near) // 2] = "changed"
    return [
        *made,
        made[0],
        made[0],
        " ".join(near),
        "",
        None,
        "   \n\t ",
        "one",
        "One",
        "x" * 700,
        "ab" * 400,
        PASSAGE + made[5],
        made[6] + PASSAGE,
        PASSAGE * 3,
        "l'été — 東京 😀 <|endoftext|> it's 123  \n\n end؀\U0003fc3b",
        " ".join(made) * 4,
        "Ä" * 300,
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def nameless(spark):
    return spark.createDataFrame([(None, PASSAGE, None, None, None, None, None), (None, PASSAGE, None, None, None, None, None), (5, None, None, None, None, None, None)], DOCS)


def ids_of(text):
    return Tokenizer.from_str(SPEC).encode(text or "", add_special_tokens=False).ids


def test_stable_characters_are_classed_alike():
    bpe, stable = byte_bpe.ByteBpe(SPEC), __import__("re").compile(byte_bpe.STABLE)
    for low in range(0, 0x10000, 512):
        chars = [chr(c) for c in range(low, low + 512) if stable.fullmatch(chr(c))]
        text = "".join(f"a{c}1{c}! {c}{c} " for c in chars)
        pieces = [text[a:b] for _, (a, b) in bpe.library.pre_tokenizer.pre_tokenize_str(text)]
        assert bpe.pattern.findall(text) == pieces


def test_packing_covers_every_id_once(docs, texts, nameless, empty):
    pieces = packing.pack(docs, SPEC, window=128, open_windows=4, worth_a_cut=16).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(range(len(texts)))
    for doc_id, own in by_doc.items():
        full = [*ids_of(texts[doc_id]), 1]
        found = b"".join(bytes(p.ids) for p in sorted(own, key=lambda p: p.start))
        assert np.frombuffer(found, "<u4").tolist() == full
        assert {p.doc_tokens for p in own} == {len(full)}
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *itertools.accumulate(p.length for p in own)][:-1]
        assert sum(p.length for p in own) <= 128
    total = sum(p.length for p in pieces)
    assert total / (128 * len(by_sequence)) > 0.9
    assert packing.pack(nameless, SPEC).count() == 3
    assert packing.pack(empty, SPEC).count() == 0


@pytest.mark.parametrize("chunk_bytes", [1, 4000, 1 << 24])
def test_token_counts_equal_the_library(docs, texts, chunk_bytes):
    found = {r.doc_id: r for r in token_counts.count_tokens(docs, SPEC, limit=100, chunk_bytes=chunk_bytes).collect()}
    for i, t in enumerate(texts):
        assert (found[i].n_tokens, found[i].n_bytes) == (len(ids_of(t)), len((t or "").encode()))
        assert found[i].over_limit == (found[i].n_tokens > 100)


def test_token_counts_without_ids_or_rows(nameless, empty):
    assert [r.n_tokens for r in token_counts.count_tokens(nameless, SPEC).orderBy("n_tokens").collect()][0] == 0
    assert token_counts.count_tokens(empty, SPEC).count() == 0


def test_suffix_automaton_phrases_equal_search():
    text = np.array([2, 3, 2, 2, 3, 4, 0, 3, 3, 2, 4, 4, 2, 0] * 3, np.uint8)
    follow = language_id.suffix_automaton(text)
    moves = np.array([((s + 1) * 6 + c, t + 1) for s, edges in enumerate(follow) for c, t in edges.items()])
    model = language_id.Model(["x"], None, None, 6, *language_id.hashed(moves[:, 0], moves[:, 1]), np.array([1]), np.array([1.0]))
    rng = np.random.default_rng(0)
    for _ in range(30):
        asked = rng.choice([0, 2, 3, 4, 5], rng.integers(1, 40)).astype(np.uint8)
        phrases, at, raw = 0, 0, text.tobytes()
        while at < len(asked):
            size = 1
            while at + size < len(asked) and asked[at : at + size + 1].tobytes() in raw and asked[at] != 5:
                size += 1
            phrases, at = phrases + 1, at + size
        # A letter never seen is a phrase; the root takes it without a step, so what follows may join it.
        found = int(language_id.parse(asked[None], np.array([len(asked)]), model)[0, 0])
        assert found == phrases if 5 not in asked else found <= phrases


def test_language_held_out_and_edge_cases(spark, empty, nameless):
    sf = "/root/testdata/sf0.001"
    found = queries.QUERIES["op3_language_id"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = found.where("held_out").join(truth, "doc_id")
    assert held.where("lang_pred = lang").count() >= 0.95 * held.count()
    train = spark.createDataFrame([(1, "the cat and the dog sat there", "en"), (2, "le chat et le chien sont là", "fr"), (3, None, "de"), (4, "x", None)], "doc_id bigint, text string, lang string")
    model = language_id.fit(train)
    asked = spark.createDataFrame(rows_of(["the dog and the cat", "le chien et le chat", "", None, "123 !!", "漢字", "THE DOG " * 3000]), DOCS)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(asked, model, ["doc_id"]).collect()}
    assert [got[i][0] for i in (0, 1, 2, 3, 4, 6)] == ["en", "fr", "und", "und", "und", "en"]
    assert got[2][1] == 0.0 and all(0 <= s <= 1 for _, s in got.values())
    assert language_id.identify(empty, model, ["doc_id"]).count() == 0
    nothing = language_id.fit(train.limit(0))
    assert {r.lang_pred for r in language_id.identify(nameless, nothing, ["doc_id"]).collect()} == {"und"}


def test_fingerprints_equal_brute_force(docs, texts):
    found = {r.doc_id: r for r in simhash.fingerprints(docs).collect()}
    order = sorted(range(len(texts)), reverse=True)
    prints = {}
    for k, i in enumerate(order):
        t, after = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert found[i].n_chars == len(t)
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(t, found[i].fingerprint) == found[i].fingerprint
        assert found[i].next_id == order[(k + 1) % len(order)]
        bits = bin(int(found[i].fingerprint, 16) ^ int(found[found[i].next_id].fingerprint, 16)).count("1")
        assert found[i].near_next == pytest.approx(1 - bits / 128)
    assert prints[""] == "0" * 32


def test_fingerprint_order_over_sparse_ids(spark, empty, nameless):
    ids = [-(1 << 60), -5, 0, 1, 1023, 1024, 1 << 20, (1 << 40) + 7, (1 << 62) + 1]
    found = simhash.fingerprints(spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id bigint, text string")).collect()
    after = dict(zip(sorted(ids, reverse=True), [*sorted(ids, reverse=True)[1:], max(ids)]))
    assert {r.doc_id: r.next_id for r in found} == after
    assert simhash.fingerprints(empty).count() == 0
    assert sorted((r.doc_id is None, r.near_next is None) for r in simhash.fingerprints(nameless).collect()) == [(False, False), (True, True), (True, True)]


def test_near_fingerprints_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    prints = [int.from_bytes(rng.bytes(16), "big") for _ in range(30)]
    prints += [p ^ sum(1 << int(b) for b in rng.choice(128, rng.integers(1, 6), replace=False)) for p in prints] + prints[:5]
    df = spark.createDataFrame([(f"{p:032x}",) for p in prints] + [(None,)], "fingerprint string")
    found = {(r.asked_print, r.fingerprint): r.copies for r in simhash.near_fingerprints(df, df, 3).collect()}
    count = collections.Counter(prints)
    assert found == {(f"{a:032x}", f"{b:032x}"): count[b] for a in count for b in count if bin(a ^ b).count("1") <= 3}


def brute_repeats(texts, length):
    seen, out = set(), []
    for t in texts:
        data = (t or "").encode()
        spans = []
        for x in range(len(data) - length + 1):
            part = data[x : x + length]
            if part in seen:
                if spans and x <= spans[-1][1]:
                    spans[-1][1] = x + length
                else:
                    spans.append([x, x + length])
            seen.add(part)
        out.append(spans)
    return out


@pytest.mark.parametrize(("segment", "hot"), [(1 << 20, 16), (300, 1)])
def test_suffix_dedup_equals_brute_force(docs, texts, monkeypatch, segment, hot):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    for i, spans in enumerate(brute_repeats(texts, 100)):
        data = (texts[i] or "").encode()
        assert [[s.begin, s.end] for s in found[i].spans] == spans
        at, left = 0, b""
        for b, e in spans:
            left, at = left + data[at:b], e
        assert bytes(found[i].kept) == left + data[at:]


def test_suffix_dedup_edges(nameless, empty, spark):
    assert [bytes(r.kept) for r in suffix_dedup.remove_repeats(nameless).where("doc_id is null").collect()] == [PASSAGE.encode()] * 2
    assert suffix_dedup.remove_repeats(empty).count() == 0
    cut = spark.createDataFrame([(1, "é" * 80), (2, "aé" + "é" * 70 + "b")], "doc_id bigint, text string")
    assert all(isinstance(r.kept, str) and "�" not in r.kept for r in suffix_dedup.remove_repeats(cut, as_text=True).collect())


def test_suffix_dedup_hands_texts_on_in_lots(monkeypatch):
    """The tasks' work is per lot, not per text: thousands of short texts cost a few batches and hashings."""
    loads = []
    load = suffix_dedup.Rolling.load
    monkeypatch.setattr(suffix_dedup.Rolling, "load", lambda self, data: (loads.append(len(data)), load(self, data))[1])
    texts = [f"{i:04d} {PASSAGE}" for i in range(2000)]
    starts = len(texts[0]) - 100
    found = list(suffix_dedup.parse([(i, t.encode()) for i, t in enumerate(texts)], 100, suffix_dedup.Rolling()))
    _, _, doc, at, first, last = found
    marks = [[int(a << 18 | a - f << 10 | a - e << 2) for a, f, e in zip(at[doc == i], first[doc == i], last[doc == i])] for i in range(2000)]
    ids = pa.array(range(2000))
    loads.clear()
    rows = pa.RecordBatch.from_arrays([ids, pa.array(texts), pa.array(marks, pa.list_(pa.int64()))], names=["doc_id", "text", "doubted"])
    stretches = list(suffix_dedup.stretch_lister(100)(iter([rows])))
    assert len(stretches) == len(loads) == 1
    covered = collections.Counter()
    for r in stretches[0].to_pylist():
        covered[r["doc_id"]] += r["n"]
        assert r["bytes"] == texts[r["doc_id"]].encode()[r["low"] - r["skip"] :][: len(r["bytes"])]
    assert set(covered.values()) == {starts + 1} and len(covered) == 2000

    none = pa.nulls(2000, pa.list_(pa.int64()))
    rows = pa.RecordBatch.from_arrays([ids, pa.array(texts), rows.column(2), none, none], names=["doc_id", "text", "repeated", "doubted", "first"])
    left = pa.Table.from_batches(suffix_dedup.remover(100, False)(iter([rows])))
    assert left["kept"].to_pylist() == [b""] * 2000
    assert left["spans"].to_pylist() == [[{"begin": 0, "end": len(texts[0])}]] * 2000


def test_suffix_dedup_remover_keeps_texts_apart():
    """Runs that end with one text and begin with the next stay two, places beyond a text count for nothing."""
    marks = [[5 << 18 | 5 << 10 | 0 << 2], [9 << 18 | 9 << 10 | 0 << 2, 300 << 18], None, [], [7 << 18]]
    texts = ["x" * 105, "é" * 60, None, "", "z" * 99]
    first = [None, [3 << 8 | 2], None, None, None]
    kind = pa.list_(pa.int64())
    columns = [pa.array(range(5)), pa.array(texts), pa.array([marks[0], *[None] * 4], kind), pa.array([None, *marks[1:]], kind), pa.array(first, kind)]
    rows = pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "repeated", "doubted", "first"])
    (left,) = suffix_dedup.remover(100, False)(iter([rows]))
    assert left["spans"].to_pylist() == [[{"begin": 0, "end": 105}], [{"begin": 0, "end": 109}], [], [], []]
    assert [len(k) for k in left["kept"].to_pylist()] == [0, 11, 0, 0, 99]


def test_suffix_dedup_deals_texts_once(docs):
    out = suffix_dedup.remove_repeats(docs, keep=["lang", "source"], as_text=True)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_saved_leaves_no_shuffle(spark):
    def shuffled():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {p for d in folders for p in glob.glob(f"{d}/*/shuffle_*")}

    before = shuffled()
    table = saved(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 10).alias("k")).count(), "counts")
    ended = time.monotonic() + 10
    while shuffled() - before and time.monotonic() < ended:
        time.sleep(0.1)
    assert not shuffled() - before
    assert spark.conf.get(common.CLEANUP) == "false"
    assert sorted(tuple(r) for r in table.collect()) == [(k, 100) for k in range(10)]


def every_path(lattice, text):
    mark = piece_lattice.MARK
    section, found = mark + text.replace(" ", mark), []

    def walk(i, score, ids):
        if i == len(section):
            found.append((score, ids))
            return
        for j in range(i + 1, len(section) + 1):
            if section[i:j] in lattice.pieces:
                s, own = lattice.pieces[section[i:j]]
                walk(j, score + s, ids + own)
        if section[i] not in lattice.pieces:
            s, own = lattice.fallback(section[i])
            walk(i + 1, score + s, ids + own)

    walk(0, 0.0, ())
    return sorted((s for s, _ in found), reverse=True)


def test_lattice_pieces_are_walked_by_characters(texts):
    """No slice of a text is made or hashed to find the pieces that begin at a place."""
    lattice = piece_lattice.Lattice(piece_lattice.read_model(public_tokenizers.path("piece_bpe_32k.model")), 3)
    for piece, (score, ids) in lattice.pieces.items():
        node = lattice.starts[piece[0]]
        for character in piece[1:]:
            node = node[2][character]
        assert node[:2] == [score, piece_lattice.packed_ids(ids)]
    unseen = "\U0001f9ff"
    assert unseen not in lattice.pieces
    assert lattice.starts[unseen] == [lattice.fallback(unseen)[0], piece_lattice.packed_ids(lattice.fallback(unseen)[1]), None]
    for section in {s for text in texts for s in lattice.split(text or "")} - {None}:
        score, _, lost = lattice.best(section)
        paths = lattice.search(section)
        assert score == pytest.approx(paths[0][0])
        assert lost == (pytest.approx(paths[0][0] - paths[1][0]) if len(paths) > 1 else math.inf)


def test_lattice_n_best_and_round_trip(spark, docs, texts, empty):
    model = piece_lattice.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    lattice = piece_lattice.Lattice(model, 5)
    for text in ("the cat", "a  bc d", "été 😀 x", "no on in", " ", "on on"):
        found = lattice.encode(text)
        assert [s for s, _ in found] == pytest.approx(every_path(lattice, text)[:5])
        assert len({ids for _, ids in found}) == len(found)
    encoded = piece_lattice.encode(docs, model, 2)
    flat = encoded.select("doc_id", F.explode("nbest").alias("s")).select("doc_id", "s.ids")
    for r in piece_lattice.decode(flat, model).collect():
        assert r.text == (texts[r.doc_id] or "")
    assert lattice.decode(lattice.encode("a▁b ▁")[0][1]) == "a▁b ▁"
    assert piece_lattice.encode(empty, model).count() == 0


def test_rules_held_out_and_edges(spark, empty):
    found = queries.QUERIES["op7_rule_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = found.where("held_out").join(labels, "doc_id")
    assert held.where("predicted = quality").count() >= 0.95 * held.count()
    assert found.where("score < 0 or score > 1 or score is null").count() == 0
    nothing = rule_quality.fit(rule_quality.measure(empty, ["doc_id"]).withColumn("label", F.lit(None).cast("int")))
    asked = spark.createDataFrame(rows_of(["", None, "word " * 50_000]), DOCS)
    scored = rule_quality.score(rule_quality.measure(asked, ["doc_id"]), nothing)
    assert [r["score"] for r in scored.collect()] == [0.5] * 3


def test_tree_paths_and_compiled_rules():
    debug = " Tree 0\n  If (feature 0 <= 1.5)\n   If (feature 1 <= 2.0E-4)\n    Predict: 0.0\n   Else (feature 1 > 2.0E-4)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n"
    a, b = ("x", True, 1.5), ("y", True, 2e-4)
    assert rule_quality.tree_paths(debug, ["x", "y"]) == {(a,), (a, b), (a, ("y", False, 2e-4)), (("x", False, 1.5),)}


def jaccard_components(texts, width, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)})
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize(("width", "rounds"), [(2, 2), (5, 2), (2, 0)])
def test_near_duplicates_equal_brute_force(docs, texts, width, rounds):
    wanted, sizes = jaccard_components(texts, width, 80)
    found = {r.doc_id: r for r in circulant_minhash.near_duplicates(docs, width=width, star_rounds=rounds).collect()}
    assert [found[i].component_id for i in range(len(texts))] == wanted
    assert [found[i].n_shingles for i in range(len(texts))] == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


def test_near_duplicates_edges(nameless, empty):
    found = circulant_minhash.near_duplicates(nameless).collect()
    assert sorted((r.component_id, r.kept) for r in found if r.doc_id is not None) == [(5, True)]
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    assert circulant_minhash.near_duplicates(empty).count() == 0


def test_shared_shingles_equal_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(9)]
    assert (circulant_minhash.shared_shingles(sets, sets, 7) == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]).all()


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(300, 300)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 60)}


def test_url_rules_equal_sql(spark, duck_pages):
    rules = spark.createDataFrame([("block", "com", "/"), ("allow", "a.com", "/x"), ("block", "b.a.com", "/x/y"), ("allow", "a.com", "/x"), ("block", "org", "")], "verdict string, host string, path string")
    pages = spark.createDataFrame(duck_pages, "page_id bigint, url string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge_urls(pages, rules, salts=3).collect()}
    table = [("block", "com", "/"), ("allow", "a.com", "/x"), ("block", "b.a.com", "/x/y"), ("block", "org", "")]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for page_id, url in duck_pages:
        rest = url.split("://", 1)[1] if url and "://" in url else None
        host = __import__("re").split("[/?#]", rest)[0] if rest is not None else ""
        path = __import__("re").split("[?#]", rest[len(host) :])[0] if rest is not None else ""
        host = host.translate(lower)
        fits = [(len(h + p), len(h), h + p, v) for v, h, p in table if rest is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert found[page_id] == (host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else "allow")
    assert url_filters.judge_urls(pages, rules.limit(0)).where("verdict = 'allow' and rule is null").count() == len(duck_pages)
    assert url_filters.judge_urls(pages.limit(0), rules).count() == 0


@pytest.fixture
def duck_pages():
    urls = [None, "", "no scheme", "http://A.com/x/y?q", "https://b.a.com/x/y/z#t", "http://b.a.com/q", "ftp://com/", "http://com", "http://x.org", "http://aa.com/x"]
    urls += ["http://c.b.a.com/x/y", "http://a.com:80/x", "://a.com/x", "http://", "http://É.com/x", "http://a.com", "http://..com/x"]
    return list(enumerate(urls + urls))


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16)).astype(np.float32)
    near = (base[:25] + 0.1 * rng.normal(size=(25, 16))).astype(np.float32)
    vectors = [*base.tolist(), *near.tolist(), base[0].tolist(), base[0].tolist(), (2 * base[1]).tolist()]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] * 16, [1.0, 0.0]]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors + odd)] + [(None, base[0].tolist(), 0)], "vec_id bigint, embedding array<float>, label int")
    found = {r.vec_id: r for r in projection_forest.near_vectors(df, leaf_size=20, spill=0.2, block_rows=7).collect()}
    x = np.array(vectors, np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    wanted = close.sum(axis=1)
    got = np.array([found[i].n_links for i in range(len(vectors))])
    assert (got <= wanted).all() and got.sum() >= 0.9 * wanted.sum()
    assert all(found[len(vectors) + k].n_links == 0 and found[len(vectors) + k].kept for k in range(len(odd)))
    whole = {r.vec_id: r.n_links for r in projection_forest.near_vectors(df, leaf_size=1000, block_rows=7).collect()}
    assert [whole[i] for i in range(len(vectors))] == wanted.tolist()
    assert projection_forest.near_vectors(df.limit(0)).count() == 0


def test_op1_digest(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.QUERIES["op1_packing"](spark, sf).collect():
        part = [*ids_of(texts[r.doc_id]), 1][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())


def hot_vectors(rows, dim, mean, rng):
    """Unit vectors, a third of them around one centre, a tenth beside another row; the pairs of cosine 0.9 or more."""
    x = rng.normal(size=(rows, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hot, some = rows // 3, rows // 10
    x[:hot] = x[0] + rng.normal(size=(hot, dim)) * np.sqrt((1 - mean) / mean / dim)
    x[hot : hot + some] = x[-some:] + 0.4 * rng.normal(size=(some, dim)) / np.sqrt(dim)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    y = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    close = y @ y.T >= 0.9
    np.fill_diagonal(close, False)
    return x, close


def test_near_vectors_of_a_hot_cluster_at_the_defaults(spark):
    x, close = hot_vectors(6000, 16, 0.93, np.random.default_rng(7))
    wanted = close.sum(axis=1)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<float>").repartition(4)
    found = {r.vec_id: r.n_links for r in projection_forest.near_vectors(df).collect()}
    got = np.array([found[i] for i in range(len(x))])
    assert (got <= wanted).all() and len(found) == len(x)
    for part in (slice(0, 2000), slice(2000, None)):
        assert got[part].sum() >= 0.95 * wanted[part].sum()


@pytest.mark.parametrize("dim", [16, 64])
def test_forest_cut_deep_keeps_pairs_together(dim):
    x, close = hot_vectors(12_000, dim, 0.915, np.random.default_rng(8))
    x = projection_forest.unit_rows(pa.array(x.tolist(), pa.list_(pa.float32())), dim)
    spill = projection_forest.spacing(0.9, dim) / 4
    forest = projection_forest.fitted(x, 8, 0.9, spill, None, 11)
    for begin, end in ((0, 100), (4000, 12_000)):
        i, j = np.nonzero(close[begin:end])
        i += begin
        shared = np.zeros(len(i), bool)
        for tree in forest:
            projection_forest.together(tree, x[i], x[j], np.arange(len(i)), spill, shared)
        assert shared.mean() >= 0.95
    a, b = np.sort(np.random.default_rng(1).integers(0, 40, (2, 30, 6)), axis=2)
    i, j = (k.ravel() for k in np.indices((30, 30)))
    assert projection_forest.share_before(a, b, 20)[i, j].tolist() == [bool(set(a[p]) & set(b[q]) & set(range(20))) for p, q in zip(i, j)]


@pytest.mark.parametrize("radius", [0, 4, 7, 15, 18])
def test_near_fingerprints_of_wide_radius_equal_brute_force(spark, radius):
    rng = np.random.default_rng(6)
    prints = [int.from_bytes(rng.bytes(16), "big") for _ in range(20)] + [(1 << 128) - 1, 0]
    prints += [p ^ sum(1 << int(b) for b in rng.choice(128, n, replace=False)) for p in prints for n in (1, 4, 5, 8, 14, 15, 16, 18, 19)]
    df = spark.createDataFrame([(f"{p:032x}",) for p in prints] + [(None,)], "fingerprint string")
    found = [((r.asked_print, r.fingerprint), r.distance) for r in simhash.near_fingerprints(df, df, radius).collect()]
    count = collections.Counter(prints)
    assert len(found) == len(dict(found))
    assert dict(found) == {(f"{a:032x}", f"{b:032x}"): bin(a ^ b).count("1") for a in count for b in count if bin(a ^ b).count("1") <= radius}


def test_near_fingerprints_find_edited_copies(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 11))) for _ in range(5000)]
    made, pairs = [], 0
    for _ in range(120):
        text = rng.choice(vocabulary, rng.integers(100, 400)).tolist()
        edited = list(text)
        for at in rng.choice(len(text), max(1, len(text) // 50), replace=False):
            edited[at] = vocabulary[rng.integers(len(vocabulary))]
        a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (text, edited))
        if len(a & b) >= 0.8 * len(a | b):
            made += [" ".join(text), " ".join(edited)]
            pairs += 1
    prints = {r.doc_id: r.fingerprint for r in simhash.fingerprints(spark.createDataFrame(rows_of(made), DOCS)).collect()}
    df = spark.createDataFrame([(p,) for p in prints.values()], "fingerprint string")
    found = {(r.asked_print, r.fingerprint) for r in simhash.near_fingerprints(df, df).collect()}
    assert pairs > 60
    assert sum((prints[2 * k], prints[2 * k + 1]) in found for k in range(pairs)) >= 0.95 * pairs
    near = queries.QUERIES["op4_simhash"](spark, "/root/testdata/sf0.001").collect()
    count = collections.Counter(int(r.fingerprint, 16) for r in near)
    for r in near:
        wanted = sum(n for p, n in count.items() if bin(p ^ int(r.fingerprint, 16)).count("1") <= simhash.RADIUS) - 1
        assert r.n_near == (wanted if r.doc_id % 50 == 0 else None)


def test_domains_of_one_last_label_are_dealt_over_salts(spark, monkeypatch):
    swept, as_of = [], url_filters.as_of
    monkeypatch.setattr(url_filters, "as_of", lambda points, asked, keys: swept.append((asked, keys)) or as_of(points, asked, keys))
    rules = spark.createDataFrame([("block", "com", "/")], "verdict string, host string, path string")
    pages = spark.createDataFrame([(i, f"http://d{i}.com/x") for i in range(200)], "page_id bigint, url string")
    assert url_filters.judge_urls(pages, rules, salts=4).where("verdict = 'block'").count() == 200
    asked, keys = swept[0]
    assert asked.groupBy(*keys).count().agg(F.max("count")).first()[0] < 100


@pytest.mark.parametrize("parts, rounds", [(1, 2), (3, 2), (2, 0)])
def test_one_doc_id_with_two_texts_loses_no_link(spark, parts, rounds):
    a, b = (" ".join(f"{c}{i}" for i in range(80)) for c in "ab")
    given = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, "something else"), (1, a), (None, a)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in given], "doc_id bigint, text string, bucket string").repartition(parts)
    found = circulant_minhash.near_duplicates(docs, width=2, star_rounds=rounds).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found if r.doc_id) == [(1, 1, True)] * 3 + [(2, 1, False), (3, 1, False), (4, 4, True)]


def test_long_texts_of_one_bucket_are_compared_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(circulant_minhash, "DEALT_ROWS", 3)
    rng = np.random.default_rng(4)
    words = [f"word{i}" for i in range(150_000)]
    texts = []
    for n in range(9):  # copies of over 1 MB, each with some words of its own
        own = list(words)
        for i in rng.choice(len(own), len(own) // 40, replace=False):
            own[i] = f"other{n}_{i}"
        texts.append(" ".join(own))
    sets = [np.sort(circulant_minhash.shingles(t, 2, circulant_minhash.WordHashes())) for t in texts]
    members = spark.createDataFrame([(7, 9, i, len(s), i) for i, s in enumerate(sets)], "bucket bigint, size bigint, id bigint, n bigint, component bigint")
    held = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "id bigint, set binary")
    links = circulant_minhash.compare_buckets(members, held, 80, block_bytes=3_000_000)
    found = {r.id: r.component for r in connected_components(links).collect()}
    assert found == dict.fromkeys(range(9), 0)


def test_sparse_moves_equal_a_dictionary():
    rng = np.random.default_rng(5)
    held = {int(k): int(t) for k, t in zip(rng.integers(0, 4000 * 37, 3000), rng.integers(1, 9000, 3000))}
    model = language_id.Model([], None, None, 37, *language_id.hashed(np.array(list(held)), np.array(list(held.values()))), np.empty(0), np.empty(0))
    assert len(model.keys) >= 2 * len(held)
    states, symbols = rng.integers(0, 4000, (200, 50)), rng.integers(0, 37, (200, 50))
    want = [[held.get(int(s * 37 + c), 0) for s, c in zip(*row)] for row in zip(states, symbols)]
    assert (model.move(states, symbols) == want).all()
    assert (language_id.Model([], None, None, 1, *language_id.hashed(np.empty(0, np.int64), np.empty(0, np.int32)), None, None).move(states, symbols * 0) == 0).all()


def test_every_language_and_letter_is_learnt(spark):
    rng = np.random.default_rng(6)
    scripts = {f"l{i:02}": "abcdefghijklmnopqrstuvwxyz" for i in range(66)}
    scripts |= {"han": [chr(0x4E00 + i) for i in range(900)], "hangul": [chr(0xAC00 + i) for i in range(900)]}
    train, asked = [], []
    for lang, letters in scripts.items():
        words = ["".join(rng.choice(list(letters), rng.integers(2, 6))) for _ in range(60)]
        line = lambda n: " ".join(rng.choice(words, n))
        train += [(len(train) + i, line(400), lang) for i in range(1 if lang == "l07" else 2)]
        asked.append((lang, line(60)))
    model = language_id.fit(spark.createDataFrame(train, "doc_id bigint, text string, lang string"))
    assert model.languages == sorted(scripts)
    found = language_id.identify(spark.createDataFrame(asked, "truth string, text string"), model, ["truth"]).collect()
    assert all(r.truth == r.lang_pred for r in found)


def test_samples_are_spread_over_long_documents(spark):
    docs = spark.createDataFrame([("a" * 50 + "b" * 50 + "c" * 50 + "d" * 50,), ("short",), ("",)], "text string")
    got = [r[0] for r in docs.select(language_id.passages("text", F.lit(20))).collect()]
    assert got == ["aaaaa\nbbbbb\nccccc\nddddd", "short", ""]


def test_many_path_rules_on_one_host(spark):
    """10,000 rules of one host, nested and apart, and of domains above it, against brute force."""
    rng = random.Random(9)
    parts = ["a", "b", "é", "long", "\U0010ffff", "~"]
    paths = {"".join(f"/{rng.choice(parts)}" for _ in range(rng.randint(0, 6))) + rng.choice(["", "/", "x"]) for _ in range(6000)}
    paths |= {f"/p{i}/{i % 7}" for i in range(10_000)}
    table = {("x.shop.com", p): rng.choice(["allow", "block"]) for p in paths}
    table |= {(h, p): rng.choice(["allow", "block"]) for h in ("com", "shop.com", "shop.org") for p in rng.sample(sorted(paths), 30)}
    rules = spark.createDataFrame([(v, h, p) for (h, p), v in table.items()], "verdict string, host string, path string")
    hosts = ["x.shop.com", "y.x.shop.com", "shop.com", "xx.shop.com", "shop.org", "x.com", "com", "org", "a." * 3000 + "com"]
    urls = [(i % 1500, f"http://{rng.choice(hosts)}{rng.choice(sorted(paths))}{rng.choice(['', '/q', 'z', '?a', '#b'])}") for i in range(2000)]
    got = url_filters.judge_urls(spark.createDataFrame(urls, "page_id bigint, url string"), rules).collect()
    want = []
    for page_id, url in urls:
        rest = url.split("://")[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        fits = [(len(h + p), h.count("."), h + p, table[h, p]) for h in ("com", "shop.com", "x.shop.com", "shop.org") if host == h or host.endswith("." + h) for p in (path[:n] for n in range(len(path) + 1)) if (h, p) in table]
        want.append((page_id, host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else "allow"))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_a_hot_domain_is_dealt_by_its_count(spark, monkeypatch):
    swept, as_of = [], url_filters.as_of
    monkeypatch.setattr(url_filters, "GROUP_ROWS", 50)
    monkeypatch.setattr(url_filters, "as_of", lambda points, asked, keys: swept.append((asked, keys)) or as_of(points, asked, keys))
    rules = spark.createDataFrame([("block", "a.com", "/1"), ("allow", "b.com", "/")], "verdict string, host string, path string")
    pages = spark.createDataFrame([(i, f"http://a.com/{i}") for i in range(1000)] + [(-1, "http://a.com/1")] * 500 + [(-2, "http://b.com/")], "page_id bigint, url string")
    assert url_filters.judge_urls(pages, rules).where("verdict = 'block'").count() == 500 + 111
    asked, keys = swept[0]
    groups = asked.groupBy(*keys).count().collect()
    assert len(groups) == 21 and max(r["count"] for r in groups) < 100
