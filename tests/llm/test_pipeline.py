"""The chain of stages against plain Python, stage by stage, on the small documents and odd ones beside them."""

import collections
import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terralode.llm import rule_quality
from tests.llm.test_operators import PASSAGE, brute_repeats, ids_of, jaccard_components

SF = "/root/testdata/sf0.001"


def odd_texts(long):
    words = long.split(" ")
    words[len(words) // 2] = "changed"
    return [None, "", " \n\t", "123 !!", long, long, " ".join(words), PASSAGE + long[: len(long) // 2], long[len(long) // 2 :] + PASSAGE, "é" * 300, "l'été 東京 😀"]


@pytest.fixture(scope="module")
def chained(spark, tmp_path_factory):
    """The chain's rows, its input texts, and the quality model that it learnt."""
    folder = str(tmp_path_factory.mktemp("chain"))
    given = spark.read.parquet(f"{SF}/documents.parquet")
    long = max((r.text for r in given.where("lang = 'en'").collect()), key=len)
    odd = spark.createDataFrame([(900_000 + i, t, None, None, None) for i, t in enumerate(odd_texts(long))], given.schema)
    clashing = {"score": F.lit(2.0), "ids": F.lit("x"), "kept": F.lit(False)}
    given.unionByName(odd).withColumns(clashing).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    learnt, fit = [], rule_quality.fit
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(rule_quality, "fit", lambda *a, **k: learnt.append(fit(*a, **k)) or learnt[-1])
        rows = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    measured = {r.doc_id: r for r in rule_quality.measure(docs, ["doc_id"]).collect()}
    return rows, {r.doc_id: r.text for r in docs.collect()}, learnt[0], measured


def left_by_brute_force(texts, model, measured):
    def quality(doc_id):
        fired = (w for rule, w in model.weights.items() if all((measured[doc_id][c] <= t) == at_most for c, at_most, t in rule))
        return 1 / (1 + math.exp(-model.intercept - sum(fired)))

    in_language = [i for i in sorted(texts) if any(c.isalpha() for c in texts[i] or "")]
    good = [i for i in in_language if quality(i) >= 0.5]
    classes, _ = jaccard_components([texts[i] for i in good], 5, 80)
    single = [i for k, i in enumerate(good) if classes[k] == k]
    left = {}
    for i, spans in zip(single, brute_repeats([texts[i] for i in single], 100)):
        data, at, kept = texts[i].encode(), 0, b""
        for begin, end in spans:
            kept, at = kept + data[at:begin], end
        left[i] = (kept + data[at:]).decode("utf-8", "ignore")
    return in_language, good, single, left


def test_chain_equals_brute_force(chained):
    rows, texts, model, measured = chained
    in_language, good, single, left = left_by_brute_force(texts, model, measured)
    assert len(texts) > len(in_language) > len(good) > len(single) > 0
    assert any(left[i] != texts[i] for i in single)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(single)
    for doc_id, pieces in by_doc.items():
        ids, at = [*ids_of(left[doc_id]), 1], 0
        for p in sorted(pieces, key=lambda p: p.start):
            part = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda p: p.offset)
        assert [p.offset for p in pieces] == [0, *itertools.accumulate(p.length for p in pieces)][:-1]
        assert sum(p.length for p in pieces) <= 2048


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_chain_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
