"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.testdata import table

from . import ann, chat, exact_dedup, hmm, infill, jaccard, mixing, packing, repeats, secrets, sharding, toxicity, whitening
from .common import id_remainder

QUERIES: dict = {}
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public tokenizer's file lies (the same place on every machine)."""
    import public_tokenizers

    return public_tokenizers.path(name)


ORACLE_SQL: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


@register("op9_secrets")
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base spans, and weak parts linked to their complements."""
    return secrets.span_digest(secrets.link_credentials(table(spark, sf_dir, "documents")))


SQL_COPIES = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents),
s AS (SELECT doc_id, t, sha256(norm) AS text_sha256 FROM d)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id) AS kept,
       text_sha256
FROM s"""


@register("op7_exact_dedup", SQL_COPIES)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies among all documents, by streaming state keyed on the digest of the text."""
    return exact_dedup.copies_report(table(spark, sf_dir, "documents"))


@register("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes, range-partitioned by sampled splitters."""
    placed = sharding.shard_records(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@register("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target weights: words that the mix takes of each, and
    their pieces with shard and order."""
    _, decisions = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return decisions.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "pieces")


@register("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces in windows of 1024, packed by minimum bin slack."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents by compression distance, learned from the rows not held out."""
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op2_ann")
def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth one, by learned partitions and exact reranking."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


@register("op1_hmm")
def op1_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under a hidden Markov model, and under smoothed word counts."""
    return hmm.score_texts(table(spark, sf_dir, "documents"))


@register("op4_jaccard")
def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingles agree to three quarters."""
    groups = jaccard.group_documents(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@register("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 400-byte strings that occur elsewhere."""
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL_CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-7::BIGINT, 0::BIGINT, 'user', '</s>[INST] ok [/INST]'),
                        (-7::BIGINT, 1::BIGINT, 'assistant', '</s>[INST] ok [/INST]')) AS v(conv_id, turn, role, text)),
e AS (
  SELECT *,
         length(text) + length(text) - length(replace(text, chr(92), ''))
         + length(regexp_replace(text, '(<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<ROLE>>|<<TEXT>>|<</ROLE>>)', '\1+', 'g'))
         - length(text) AS body,
         length(role) + length(role) - length(replace(role, chr(92), ''))
         + length(regexp_replace(role, '(<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<ROLE>>|<<TEXT>>|<</ROLE>>)', '\1+', 'g'))
         - length(role) AS name
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(body + CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 ELSE 25 + name END) AS BIGINT)
         AS formatted_chars
FROM e GROUP BY conv_id"""


@register("op11_chat", SQL_CHAT)
def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, formatted as reply trees and read back."""
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = F.lit("</s>[INST] ok [/INST]")
    made = spark.range(2, numPartitions=1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), says.alias("text"))
    back = chat.read_back(chat.format_trees(chat.from_turns(told.unionByName(made)), unique=True))
    return back.select(F.col("tree").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


SQL_INFILL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tok,
         sha256('42:' || doc_id) AS h
  FROM documents),
c AS (
  SELECT doc_id, t, tok, len(tok) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(tok) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(tok) + 1) AS c2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT doc_id, t, n, form, array_to_string(tok[1:least(c1, c2)], '') AS pre,
         array_to_string(tok[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
         array_to_string(tok[greatest(c1, c2) + 1:n], '') AS suf
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""


@register("op12_infill", SQL_INFILL)
def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of all documents, and the texts restored from it."""
    made = infill.infill_documents(table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80)
    both = infill.restore_documents(made)
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


@register("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened to 8 components, from an exact scatter matrix."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"), count=8)
    # a deviation beyond a long is null (from some millions of vectors on)
    return white.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
