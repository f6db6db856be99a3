"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import chat, decontaminate, language, lexical, licenses, mixing, neardup, passages, pii, quality, topk, toxicity, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Ranking:
    return quality.fit_ranking(docs, labels.where(~quality.held_out(F.col("doc_id"), 5, 0)))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_model(docs, _table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= model.cut).cast("int").alias("predicted"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.train_field(docs))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(rows.unionByName(probe))


OP5_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), measured as (
  select *, length(regexp_replace(text,
      '(\\|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<ROLE>>|<</ROLE>>)', '\1x', 'g')) as escaped
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
  cast(sum(escaped + case role when 'assistant' then 7 when 'user' then 15 when 'system' then 15
      else 32 + length(role) end) as bigint) as formatted_chars
from measured group by conv_id
"""


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), topk.whole_vector(F.col("embedding")).alias("v"))
    return topk.exact_topk(rows.where("id % 50 = 0"), rows)


OP6_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from (select distinct vec_id, v from whole where vec_id % 50 = 0) q join whole c on q.vec_id <> c.vec_id
), ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score
  from pairs
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
"""


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.training_model(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id"), 4, 2).alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.3).cast("int").alias("predicted"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tagger = language.train_tagger(docs.where(~quality.held_out(F.col("doc_id"), 4, 2)))
    return language.predict_language(docs, tagger).select(
        "doc_id", quality.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("key"), topk.whole_vector(F.col("embedding")).alias("v"))
    return whitening.whiten(rows).withColumnRenamed("key", "vec_id")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(_table(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
with terms as (
  select row, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as row, doc_id, text from documents)
), counts as (
  select row, any_value(doc_id) as doc_id, term, count(*) as tf from terms group by row, term
), sizes as (
  select row, cast(sum(tf) as bigint) as n from counts group by row
), total as (
  select count(*) as docs, cast(sum(n) as bigint) as words from sizes
), holders as (
  select term, count(*) as df from counts group by term
), asked as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), weighed as (
  select item_id, term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w
  from asked join holders using (term), total
), scored as (
  select item_id, row, any_value(doc_id) as doc_id, cast(sum(w * ((1000000000 * tf)
    // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) as bigint) as score
  from weighed join counts using (term) join sizes using (row), total group by item_id, row
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank, doc_id, score
  from scored where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bradley_terry_quality": op1,
        "op2_mix_sources": op2,
        "op3_simhash_windows": op3,
        "op4_pii_skip_chain": op4,
        "op5_chat_template": op5,
        "op6_exact_topk": op6,
        "op7_sparse_suffixes": op7,
        "op8_order_minhash": op8,
        "op9_kneser_ney_toxicity": op9,
        "op10_crf_language": op10,
        "op11_shifted_choleskyqr": op11,
        "op12_license_scan": op12,
        "op13_bit_sliced_search": op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_chat_template": OP5_SQL,
        "op6_exact_topk": OP6_SQL,
        "op13_bit_sliced_search": OP13_SQL,
    }
