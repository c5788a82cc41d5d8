"""The registered query of each operator: whole tables, production parameters, digest columns."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import (bpe, conversations, embeddings, langid, linededup, lmscore, mixing, packing, quality, secrets, sharding,
               simhash, whitening)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    """The packing tokenizer: $URBANFLOW_TOKENIZER, or the installed public vocabulary."""
    import public_tokenizers

    return os.environ.get("URBANFLOW_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4, carry=["doc_id"])
    return found.select("doc_id", "fingerprint", "component_id")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(table(spark, sf_dir, "documents"), carry=["doc_id"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", *[number(k) for k in secrets.KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93, carry=["vec_id"])


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~out))
    return langid.identify(docs, model, carry=["doc_id"]).withColumn(
        "held_out", langid.held_out(F.col("doc_id"))).select("doc_id", "held_out", "lang_pred", "score")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), epochs=3, carry=["doc_id"])
            .select("doc_id", "size", "source_size", "target", "taken"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (lmscore.score(table(spark, sf_dir, "documents"), carry=["doc_id"])
            .select("doc_id", "n_tokens", "log_prob", "mean_log_prob"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_common_lines(table(spark, sf_dir, "documents"), min_documents=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return (quality.quality(table(spark, sf_dir, "documents"), labels, carry=["doc_id"])
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "kept", "score"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), carry=["vec_id"], number=16)
    return found.select("*", F.posexplode("whitened").alias("at", "value")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        F.col("value").alias("whitened"), F.get("explained", "at").alias("explained"), "identity_error")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair(rows, gone_col="gone").select("conv_id", *conversations.RESULTS)


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), carry=["doc_id"], decoded=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_secrets": op2_secrets,
    "op3_embeddings": op3_embeddings,
    "op4_packing": op4_packing,
    "op5_language": op5_language,
    "op6_sharding": op6_sharding,
    "op7_mixing": op7_mixing,
    "op8_lm_score": op8_lm_score,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_conversations": op12_conversations,
    "op13_bpe": op13_bpe,
}

# What SQL can confirm of operators whose whole result it cannot: the same operators, the columns that have SQL.


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


def shard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each shard, largest first, and the bytes of all."""
    sizes = op6_sharding(spark, sf_dir).groupBy("shard").agg(F.count("*").alias("n_rows"), F.max("slot").alias("last"), F.sum("size").alias("size"))
    place = F.row_number().over(Window.orderBy(F.desc("n_rows"), "shard")) - 1  # eight rows
    return sizes.select(place.alias("place"), "n_rows", (F.col("last") == F.col("n_rows") - 1).alias("gapless"),
                        F.sum("size").over(Window.partitionBy()).alias("total_size"))


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: its size and target, and whether the words taken come within a document's size of it."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, weights=(5.0, 2.0, 1.0), epochs=3, carry=["source"])
    per = mixed.groupBy("source").agg(F.count("*").alias("n_docs"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
                                      F.sum("taken").alias("taken"), F.max("size").alias("largest"))
    return per.select("source", "n_docs", "source_size", F.round("target", 3).alias("target"),
                      (F.abs(F.col("taken") - F.col("target")) <= 2 * F.max("largest").over(Window.partitionBy())).alias("near_target"))


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_quality(spark, sf_dir).drop("kept", "score")


def whitening_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_whitening(spark, sf_dir).where("component = 1").select("vec_id", "n", "deviation")


SQL_QUERIES = {
    "secret_counts": secret_counts,
    "shard_sizes": shard_sizes,
    "mix_targets": mix_targets,
    "quality_base": quality_base,
    "whitening_deviation": whitening_deviation,
}

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

SQL_ORACLE = {
    "secret_counts": """
SELECT doc_id,
  len(list_filter(regexp_extract_all(coalesce(text, ''), '(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1),
                  lambda v: length(v) >= 12)) AS n_assign,
  len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda v: length(v) >= 18)) AS n_access,
  len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda v: length(v) >= 16)) AS n_hex
FROM documents""",
    "shard_sizes": """
WITH d AS (SELECT count(*) AS n, sum(coalesce(strlen(text), 0) + 1) AS total FROM documents)
SELECT CAST(place AS INTEGER) AS place, n // 8 + CAST(place < n % 8 AS BIGINT) AS n_rows, true AS gapless, CAST(total AS BIGINT) AS total_size
FROM d, range(8) r(place)""",
    "mix_targets": f"""
WITH s AS (SELECT source, count(*) AS n_docs, CAST(sum(len({_WORDS})) AS BIGINT) AS size FROM documents GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM s),
c AS (SELECT *, 3.0::DOUBLE * size / weight AS ratio, sum(size) OVER () AS budget FROM w),
l AS (SELECT a.ratio, (max(a.budget) - coalesce(sum(b.size * 3) FILTER (WHERE b.ratio < a.ratio), 0)) / sum(b.weight) FILTER (WHERE b.ratio >= a.ratio) AS level
      FROM c a, c b GROUP BY a.ratio),
f AS (SELECT arg_min(level, ratio) FILTER (WHERE ratio > level) AS level FROM l)
SELECT source, n_docs, size AS source_size,
  round(CASE WHEN f.level IS NULL OR ratio <= f.level THEN 3.0 * size ELSE f.level * weight END, 3) AS target, true AS near_target
FROM c, f""",
    "quality_base": f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
w AS (SELECT row, i, array_to_string(words[i:i + 7], ' ') AS win FROM d, range(1, len(words) - 6) r(i) WHERE len(words) >= 8),
t AS (SELECT row, win FROM w GROUP BY row, win HAVING count(*) > 1),
p AS (SELECT w.row, count(DISTINCT i + k) AS n FROM w JOIN t ON t.row = w.row AND t.win = w.win, range(8) q(k) GROUP BY w.row),
l AS (SELECT row, count(*) - count(DISTINCT line) AS n FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d) x
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY row)
SELECT doc_id, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda v: length(v))), 0) AS BIGINT) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words,
  len(words) < 20 OR 100 * coalesce(p.n, 0) > 30 * len(words) AS base_failed
FROM d LEFT JOIN p ON p.row = d.row LEFT JOIN l ON l.row = d.row""",
    "whitening_deviation": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64.0::DOUBLE * c::DOUBLE) AS HUGEINT) + 1000000) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
f AS (SELECT DISTINCT x FROM v),
s AS (SELECT i, sum(x[i]) AS s, count(*) AS n FROM f, range(1, (SELECT max(len(x)) FROM f) + 1) r(i) GROUP BY i)
SELECT vec_id, any_value(n) AS n, CAST(sum((n * x[i] - s) * (n * x[i] - s)) AS BIGINT) AS deviation FROM v, s GROUP BY vec_id""",
}

_SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

OP9_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT row, doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS pos, text FROM docs),
keyed AS (SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN c.key IS NULL THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key
GROUP BY k.row, k.doc_id
"""

#: the others are tested against brute force (tests/llm)
ORACLE: dict[str, str] = {"op9_line_dedup": OP9_SQL, **SQL_ORACLE}
