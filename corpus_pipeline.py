"""The training corpus: documents filtered, deduplicated and packed, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.llm import byte_bpe, circulant_minhash, language_id, packing, rule_quality, suffix_dedup
from terralode.llm.common import saved
from terralode.queries.registry import table

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Texts scoring below go; labelled clean texts score near 1, bad ones near 0.
LEAST_QUALITY = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language that was learnt; those without text or letters go. A missing ``lang`` is filled in."""
    model = language_id.fit(docs)
    found = language_id.identify(docs, model, COLUMNS)
    return found.where("lang_pred <> 'und'").withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules learnt from ``labels`` take for good."""
    measured = saved(rule_quality.measure(docs, COLUMNS), "measured")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = rule_quality.fit(measured.select("doc_id", *rule_quality.STATISTICS).join(labels, "doc_id"))
    return rule_quality.score(measured, model).where(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def one_of_a_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: runs of five words, similarity of 0.8 or more."""
    found = circulant_minhash.near_duplicates(docs, width=5, percent=80)
    copies = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(copies, "doc_id", "left_anti").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of 100 bytes that stand earlier in the corpus; ``n_chars`` follows the text."""
    kept = suffix_dedup.remove_repeats(docs, keep=["lang", "source"], as_text=True)
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("bigint").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of sequences of 2048 tokens; ids are told by their checksum."""
    pieces = packing.pack(docs, byte_bpe.read_spec(BPE_FILE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near duplicates", one_of_a_kind),
    ("repeated passages", without_repeats),
    ("packing", packed),
]

# Trained models and suffix order are beyond SQL; the stages' operators are tested one by one, the chain is tested against plain Python in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
