"""The operators' registered queries, each on its whole table, beside their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.llm import (
    benchmark_leaks,
    byte_bpe,
    circulant_minhash,
    conversation_repair,
    language_id,
    packing,
    piece_lattice,
    projection_forest,
    rule_quality,
    simhash,
    spelling_variants,
    suffix_dedup,
    token_counts,
    url_filters,
)
from terralode.llm.common import saved
from terralode.queries.registry import Query, table
from terralode.session import local_rows

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def registered(pipeline) -> tuple[dict[str, Query], dict[str, str]]:
    """All queries and SQL, the pipeline's among them."""
    sql = {} if pipeline.ORACLE_SQL is None else {"pipeline": pipeline.ORACLE_SQL}
    return QUERIES | {"pipeline": pipeline.run}, ORACLES | sql


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), byte_bpe.read_spec(BPE_FILE))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), byte_bpe.read_spec(BPE_FILE))


def fold(n: int):
    """A document's fold, by a checksum of its id."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(fold(4) != 2))
    found = language_id.identify(docs, model, ["doc_id"])
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprints; for ids divisible by 50 also how many other documents lie within ``simhash.RADIUS`` bits."""
    prints = saved(simhash.fingerprints(table(spark, sf_dir, "documents")), "prints")
    asks = (F.col("doc_id") % 50 == 0).alias("asks")
    near = simhash.near_fingerprints(prints.where(asks), prints.select("fingerprint"))
    near = near.groupBy(F.col("asked_print").alias("fingerprint")).agg((F.sum("copies") - 1).alias("within"))
    out = prints.join(near, "fingerprint", "left").withColumn("n_near", F.when(asks, F.col("within")))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near")


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


@query("op6_piece_lattice")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's three best segmentations, told by score, pieces and checksum."""
    found = piece_lattice.encode(table(spark, sf_dir, "documents"), piece_lattice.read_model(PIECE_FILE), 3)
    return found.select(
        "doc_id",
        F.transform("nbest", lambda s: s["score"]).alias("scores"),
        F.transform("nbest", lambda s: s["n_pieces"]).alias("n_pieces"),
        F.transform("nbest", lambda s: F.crc32(s["ids"])).alias("ids_crc32"),
    )


@query("op7_rule_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = saved(rule_quality.measure(table(spark, sf_dir, "documents"), ["doc_id"]), "measured")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = rule_quality.fit(measured.where(fold(3) != 1).join(labels, "doc_id"))
    return rule_quality.score(measured, model).select("doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


@query("op8_circulant_minhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query("op10_projection_forest")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_forest.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


@query(
    "op9_url_filters",
    r"""
  with cut as (
    select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest from pages),
  split as (
    select page_id,
           coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
    from cut),
  rules(verdict, rule_host, rule_path) as (
    values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
  fits as (
    select page_id, host, path, rule_host || rule_path as rule, verdict,
           row_number() over (partition by page_id order by length(rule_host || rule_path) desc, length(rule_host) desc) as rn
    from split left join rules
      on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
  select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where rn = 1
""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = local_rows(spark, URL_RULES, "verdict string, host string, path string")
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), rules)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with one of five faults by a checksum of conversation and turn; a null is one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text, role = space("text"), space("role")
    return (
        turns.select("conv_id", "turn", fault.alias("fault"), role.alias("role"), text.alias("text"))
        .where("fault <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    broken = damaged(turns)
    return conversation_repair.digest(broken, conversation_repair.lightest_repairs(broken, turns.select("conv_id")))


@query(
    "op12_benchmark_leaks",
    r"""
  with doc_words as (
    select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents),
  item_words as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark),
  windows as (
    select distinct item_id, least(len(w), 10) as m, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') as win
    from (select item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as i from item_words where len(w) > 0)),
  words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from doc_words),
  runs as (
    select doc_id, i, list(word) over (partition by doc_id order by i rows between current row and 9 following) as run from words),
  hits as (
    select r.doc_id, r.i, x.m, x.item_id
    from (select doc_id, i, s.m, array_to_string(list_slice(run, 1, s.m), ' ') as win
          from runs, (select distinct m from windows) s where len(run) >= s.m) r
    join windows x on r.win = x.win and r.m = x.m),
  covered as (
    select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + m)) as place from hits) group by 1),
  items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
    from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by 1)
  select d.doc_id, cast(coalesce(len(w), 0) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
         sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
  from doc_words d left join covered c on d.doc_id = c.doc_id left join items t on d.doc_id = t.doc_id
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks.digest(benchmark_leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(spelling_variants.vocabulary(table(spark, sf_dir, "documents"), damage=True))
