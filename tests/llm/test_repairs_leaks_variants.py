"""Conversation repair, benchmark leaks and spelling variants against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from terralode.llm import benchmark_leaks, conversation_repair, queries, spelling_variants

TURNS = "conv_id bigint, turn bigint, role string, text string, cost bigint, audit string, part int"


# Conversation repair


def plain_plan(rows):
    """Plan and repaired lines by a dynamic program over whole audits; rows are (turn, role, text) in order."""
    steps, seen, faults = conversation_repair.STEPS, set(), []
    for _, role, text in rows:
        body = text.strip(conversation_repair.BLANKS)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    def with_inserts(best):
        moved = True
        while moved:
            moved = False
            for state, (cost, audit, lines) in list(best.items()):
                for role in ("user", "assistant"):
                    there, new = steps[state].get(role[0]), (cost + 2, audit + "I", (*lines, f"{role}:"))
                    if there is not None and (there not in best or new[:2] < best[there][:2]):
                        best[there], moved = new, True
        return best

    best = with_inserts({0: (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        new = {}

        def offer(state, weight):
            if state not in new or weight[:2] < new[state][:2]:
                new[state] = weight

        for state, (cost, audit, lines) in best.items():
            offer(state, (cost + 3, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                more = cost + (fault == "truncated")
                if role[:1] in steps[state]:
                    offer(steps[state][role[:1]], (more, audit + "K", (*lines, f"{role}:{text}")))
                for given in ("user", "assistant"):
                    if given[0] in steps[state]:
                        offer(steps[state][given[0]], (more + 2, audit + "R", (*lines, f"{given}:{text}")))
        best = with_inserts(new)
    cost, audit, lines = min((best[s] for s in (0, 3) if s in best), key=lambda w: w[:2])
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha), lines


def in_order(rows):
    md5 = lambda t: hashlib.md5(t.encode()).digest()
    filled = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(filled, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), md5(x[2])))


@pytest.fixture(scope="module")
def talk():
    rnd = random.Random(5)
    texts = ["yes.", "no!", "cut of", "", " \n", "why? ", "é…", "a longer one. ", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "ua", "", None]
    made = {c: [(rnd.choice([None, *range(12)]), rnd.choice(roles), rnd.choice(texts)) for _ in range(rnd.randint(1, 12))] for c in range(60)}
    made[100] = [(i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(400)]  # long, and nothing to mend
    made[101] = [(i // 3, rnd.choice(["user", "assistant", "system"]), rnd.choice([f"turn {i}.", "again.", "cut"])) for i in range(700)]
    made[102] = [(1, "user", "the same.")] * 300 + [(2, "assistant", "x" * 100_000 + ".")]
    made[None] = [(0, "user", "no conversation's."), (1, "user", "y")]
    return made


def as_rows(talk):
    return [(c, *row, 7, "clash", 1) for c, rows in talk.items() for row in rows]


@pytest.mark.parametrize("parts", [2, 5])
def test_repairs_equal_a_dynamic_program(spark, talk, parts):
    turns = spark.createDataFrame(as_rows(talk), TURNS).repartition(7)
    ids = spark.createDataFrame([(c,) for c in [*talk, 999]], "conv_id bigint")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        plans = conversation_repair.lightest_repairs(turns, ids)
        found = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.digest(turns, plans).collect()}
        mended = collections.defaultdict(list)
        for r in conversation_repair.repaired_turns(turns, plans).orderBy("conv_id", "place").collect():
            mended[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found.keys() == {*talk, 999}
    for conv, rows in [*talk.items(), (999, [])]:
        want, lines = plain_plan(in_order(rows))
        assert found[conv] == want, conv
        assert mended[conv] == list(lines)


def test_runs_join_to_the_whole():
    rnd = random.Random(6)
    for _ in range(200):
        turns = [(rnd.randint(0, 3), rnd.choice("suax"), rnd.randint(1, 3) if rnd.random() < 0.2 else 1) for _ in range(rnd.randint(0, 9))]
        turns = [(f, r, n if f in (1, 3) else 1) for f, r, n in turns]
        cut = rnd.randint(0, len(turns))
        whole = conversation_repair.table_of(turns)
        assert conversation_repair.join(conversation_repair.table_of(turns[:cut]), conversation_repair.table_of(turns[cut:])) == whole
        best = next(iter(conversation_repair.derive(turns, 0, True).values()))
        assert best == min(whole[0, q] for q in conversation_repair.GOALS if (0, q) in whole)


def test_no_turns_no_plans(spark):
    none = spark.createDataFrame([], TURNS)
    plans = conversation_repair.lightest_repairs(none)
    assert conversation_repair.digest(none, plans).collect() == []
    ids = spark.createDataFrame([(3,), (3,), (None,)], "conv_id bigint")
    rows = conversation_repair.digest(none, conversation_repair.lightest_repairs(none, ids)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((tuple(r) for r in rows), key=repr) == [(3, 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty)]


def test_damage_by_checksum(spark):
    given = [(c, t, r, x) for c in range(40) for t, r, x in [(0, "system", "Be kind. Now!"), (1, "assistant", None), (None, None, "y?")]] + [(None, 5, "user", "z.")]
    got = collections.Counter(tuple(r) for r in queries.damaged(spark.createDataFrame(given, "conv_id int, turn int, role string, text string")).collect())
    want = collections.Counter()
    for c, t, r, x in given:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if fault == 4:
            r = "user"
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        if fault:
            want[(c, t, r, x)] += 2 if fault == 3 else 1
    assert got == want


# Benchmark leaks

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_leaks(text, items, window):
    words = plain_words(text)
    hit, found = [False] * len(words), set()
    for item, item_text in items:
        own = plain_words(item_text)
        size = min(window, len(own))
        for piece in {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else ():
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) == piece:
                    found.add(item)
                    hit[i : i + size] = [True] * size
    spans = [(list(g)[0][0], n) for key, g, n in ((k, g, len(g)) for k, g in ((k, list(g)) for k, g in itertools.groupby(enumerate(hit), key=lambda x: x[1]))) if key]
    return len(words), spans, sorted(str(i) for i in found if i is not None)


def made_leaks():
    rnd = random.Random(8)
    words = ["one", "Two", "three", "vier", "füнf", "six", "7", "ⅷ"]
    line = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(words) for _ in range(n))
    items = [(i, line(n)) for i, n in enumerate([1, 2, 3, 4, 5, 8, 12, 20, 4, 6])]
    items += [(3, items[3][1]), (50, None), (51, " .,- "), (None, line(5)), (52, "only-here")]
    docs = [(i, line(rnd.randint(0, 40))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, "?!"), (None, "a " + items[7][1] + " b"), (5, docs[5][1]), (5, docs[5][1]), (5, items[6][1]), (103, "x " * 50_000 + items[9][1])]
    return docs, items


@pytest.mark.parametrize("window, block_words", [(4, 10**6), (10, 10**6), (4, 20), (1, 10**6)])
def test_leaks_equal_brute_force(spark, rows, window, block_words):
    docs, items = made_leaks()
    if window == 10:  # short items would hit everything
        items = [x for x in items if len(plain_words(x[1])) > 5]
    given = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id bigint, text string, items string, n_words int").repartition(3)
    tests = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id bigint, text string, item string")
    found = benchmark_leaks.find_leaks(given, tests, window, block_words)
    got = sorted(((r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], r["items"]) for r in found.collect()), key=repr)
    assert got == sorted(((i, *plain_leaks(t, items, window)) for i, t in docs), key=repr)


def test_long_items_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(benchmark_leaks, "PIECE_WORDS", 6)
    words = [f"w{i}" for i in range(40)]
    tests = spark.createDataFrame([("1", " ".join(words))], "item_id string, text string")
    for window in (1, 3, 5):
        pieces = [bytes(x).decode().split() for b in benchmark_leaks.piece_cutter(window)(iter(tests.toArrow().to_batches())) for x in b.column(2).to_pylist()]
        windows = lambda w: {tuple(w[i : i + window]) for i in range(len(w) - window + 1)}
        assert set().union(*map(windows, pieces)) == windows(words)
        assert all(window <= len(p) <= 6 for p in pieces)


def test_leaks_are_cut_out(spark):
    tests = spark.createDataFrame([(1, "b c d"), (2, "x y")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "A é, B-c; d! e x  y f"), (2, "x y"), (3, None), (4, "")], "doc_id bigint, text string")
    found = benchmark_leaks.find_leaks(docs, tests, 3, keep_text=True)
    cut = lambda *limits: {r["doc_id"]: r["kept_text"] for r in benchmark_leaks.remove_leaks(found, *limits).collect()}
    assert cut() == {1: "A é, ! e  f", 2: "", 3: None, 4: ""}
    assert cut(2) == {1: "A é, ! e x  y f", 2: "x y", 3: None, 4: ""}
    assert cut(0, 0.9) == {1: "A é, ! e  f", 3: None, 4: ""}


def test_no_items_no_leaks(spark, rows):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    found = benchmark_leaks.digest(benchmark_leaks.find_leaks(docs, none))
    empty = hashlib.sha256(b"").hexdigest()
    assert rows(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == [(1, 2, 0, 0, empty, False), (None, 0, 0, 0, empty, False)]
    assert benchmark_leaks.find_leaks(docs.limit(0), none).collect() == []


# Spelling variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short, long = sorted((a, b), key=len)
    at = next((i for i in range(len(short)) if short[i] != long[i]), len(short))
    return short[at + 1 :] == long[at + 1 :] if len(a) == len(b) else short[at:] == long[at + 1 :]


def plain_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: f for w, f in form.items() if words[f] >= 2 * words[w]}
    out = set()
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out.add((word, form.get(word), root, n, len(near[word]), words.get(form.get(word))))
    return out


@pytest.mark.parametrize("symbols", [None, 2, 6])
def test_variants_equal_brute_force(spark, symbols):
    rnd = random.Random(9)
    words = {"".join(rnd.choice("abcé") for _ in range(rnd.randint(5, 7))): rnd.choice([3, 3, 4, 6, 7, 12, 30, 61]) for _ in range(400)}
    words |= {"aaaaa": 200, "aaaaaa": 100, "aaaaaaa": 50, "é" * 3000: 4, "é" * 2999 + "x": 9, "é" * 2999: 18, "😀abcd": 3, "😁abcd": 8}
    given = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    got = {tuple(r) for r in spelling_variants.group_variants(given, symbols=symbols).collect()}
    assert got == plain_variants(words)


def test_variants_broadcast_no_table(spark, monkeypatch):
    words = {"".join(letters) + "e": 3 + 40 * (letters[0] == letters[1]) for letters in itertools.product("abcé", repeat=4)}
    given = spark.createDataFrame(list(words.items()), "word string, n bigint")
    plans, saved = [], spelling_variants.saved

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def planned(df, purpose):
        plans.append(plan(df))
        return saved(df, purpose)

    monkeypatch.setattr(spelling_variants, "saved", planned)
    result = spelling_variants.group_variants(given)
    plans.append(plan(result))
    got = {tuple(r) for r in result.collect()}
    plans.append(plan(result))
    joins = [p.count("Join [") for p in plans]
    assert joins[:5] == [0, 0, 1, 0, 1]  # words, coded, found, ways, the first round
    assert joins[-2] == 3
    assert not [p for p in plans if "Broadcast" in p]
    assert got == plain_variants(words)


def test_neighbours_of_reduced_words_each_once():
    rnd = random.Random(10)
    for positions in (1, 2, 50):
        for _ in range(40):
            length, symbols = rnd.randint(1, 6), rnd.randint(2, 5)
            grid = np.array([[rnd.randint(1, symbols) for _ in range(length)] for _ in range(3)], np.uint64)
            got = collections.defaultdict(list)
            for row, code in spelling_variants.neighbour_blocks(grid, symbols, positions):
                for r, c in zip(row.tolist(), code.tolist()):
                    got[r].append(c)
            for r, word in enumerate(grid.tolist()):
                edits = {tuple(word)}
                edits |= {(*word[:i], *word[i + 1 :]) for i in range(length)}
                edits |= {(*word[:i], s, *word[i + 1 :]) for i in range(length) for s in range(1, symbols + 1)}
                edits |= {(*word[:i], s, *word[i:]) for i in range(length + 1) for s in range(1, symbols + 1)}
                codes = [sum(x * pow(spelling_variants.BASE, i, 2**64) for i, x in enumerate(e)) % 2**64 for e in edits]
                assert sorted(got[r]) == sorted(codes)


def test_vocabulary_counts_damaged_runs(spark, monkeypatch):
    monkeypatch.setattr(spelling_variants, "COUNTED_AT_ONCE", 3)
    rnd = random.Random(11)
    pool = ["".join(rnd.choice("abcdefGHéÀß×") for _ in range(rnd.randint(1, 8))) for _ in range(60)]
    docs = [(i, " ".join(rnd.choice(pool) for _ in range(80)) + "ΩRight4left") for i in range(60)] + [(None, "nobody nobody NOBODY"), (7, None), (8, ""), (9, "z" * 100_000)]
    want = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    given = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id bigint, text string, word string, n int").repartition(3)
    got = {r["word"]: r["n"] for r in spelling_variants.vocabulary(given, damage=True).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}


def test_no_words_no_variants(spark):
    assert spelling_variants.group_variants(spark.createDataFrame([], "word string, n bigint")).collect() == []
    assert spelling_variants.vocabulary(spark.createDataFrame([(1, None)], "doc_id bigint, text string")).collect() == []
