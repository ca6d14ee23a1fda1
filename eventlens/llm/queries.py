"""One query per operator over whole tables, each a thin digest of what the
operator returns, and the DuckDB oracles of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import (chat, conversation_repair, decontaminate, fingerprint, line_dedup, minhash, packing, pii, quality,
                           shard, substring_dedup, suffix_dedup, whitening)
from eventlens.llm.oracles import ORACLES

CONTROL = "\\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _length(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def op1_near_duplicates(spark, sf_dir):
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op2_substring_dedup(spark, sf_dir):
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), width=20)
    return found.select("doc_id", "n_words", _length("spans").alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_personal_data(spark, sf_dir):
    found = pii.entities(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


def op4_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    out = chat.read_back(chat.render(chat.conversation_events(rows.unionByName(control))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


def op5_fingerprints(spark, sf_dir):
    found = fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                        "near_edited", "near_next", "common_prefix")


def op6_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=13)
    return found.select("doc_id", "n_words", _length("hits").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", F.coalesce(quality.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_shards(spark, sf_dir):
    found = shard.shards(table(spark, sf_dir, "documents"), n_shards=16)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op9_suffix_dedup(spark, sf_dir):
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), width=50)
    return found.select("doc_id", "n_bytes", _length("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op10_pack(spark, sf_dir):
    found = packing.pack(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_whitening(spark, sf_dir):
    rows, fit, error = whitening.whiten(table(spark, sf_dir, "embeddings"), most=16)
    share = [] if fit is None else (fit.eigenvalues / fit.trace).tolist()
    share = F.array(*map(F.lit, share)).cast("array<double>")
    rows = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n if fit else 0).cast("long").alias("n"), "deviation",
                       "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def op12_conversation_repair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    audit, edited = conversation_repair.repair(conversation_repair.damage(conversations), conversations)
    digest = conversation_repair.hashes(edited).withColumnRenamed("conv_id", "_id")
    found = audit.join(digest, audit.conv_id.eqNullSafe(F.col("_id")), "left")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_line_dedup(spark, sf_dir):
    found = line_dedup.remove_repeats(table(spark, sf_dir, "documents"), min_chars=10)
    return found.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.sha2("kept_text", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_near_duplicates, op2_substring_dedup, op3_personal_data, op4_chat_format, op5_fingerprints,
           op6_decontaminate, op7_quality, op8_shards, op9_suffix_dedup, op10_pack,
           op11_whitening, op12_conversation_repair, op13_line_dedup)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
