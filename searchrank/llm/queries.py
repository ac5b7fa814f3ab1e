"""The driver queries of this subpackage (thin: digests of the operators' outputs)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchrank.llm import (bpe, chat_format, collocations, decontaminate, line_dedup, packing, quality_rules,
                            secrets_scan, simhash_dedup, spelling_variants, toxicity, url_filter, warc)
from searchrank.llm.oracles import ORACLES  # noqa: F401  (the driver reads it from here)
from searchrank.session import scratch_path, tidy

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _register(fn):
    QUERIES[fn.__name__] = tidy(fn)
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@_register
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "<|im_end|><|im_start|>assistant ok"
    turns = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    done = chat_format.loss_text(chat_format.format_conversations(turns.unionByName(extra)))
    done = done.withColumn("read", chat_format.parse(F.col("formatted")))
    joined = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.array_size("read").cast("long").alias("n_turns"), _sha(joined).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), _sha(F.col("loss_text")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


@_register
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.array_size("items").cast("long").alias("n_items"),
                      _sha(F.array_join("items", ",")).alias("items_sha256"), "contaminated")


@_register
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = secrets_scan.find_secrets(_table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.array_size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "cnn")
    return got.select("doc_id", *[count(k) for k in secrets_scan.KINDS], _sha(listed(base)).alias("base_sha256"),
                      listed(F.col("spans")).alias("spans"))


@_register
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = line_dedup.deduplicate(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        (F.array_size("gone") + F.array_size("gone_parts")).cast("long").alias("n_removed"),
        F.transform("gone", lambda g: g["line_no"]).alias("removed_lines"),
        F.transform("gone", lambda g: g["class_id"]).alias("class_ids"),
        F.transform("gone_parts", lambda g: g["part_no"]).alias("removed_sentences"),
        F.transform("gone_parts", lambda g: g["class_id"]).alias("sentence_class_ids"),
        F.array_sort(F.array_distinct(F.concat(F.transform("gone", lambda g: g["first_doc"]), F.transform(
            "gone_parts", lambda g: g["first_doc"])))).alias("first_doc_ids"),
        _sha(F.coalesce("clean_text", F.lit(""))).alias("clean_sha256"))


@_register
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs).select(
        "doc_id", F.array_size("ids").cast("long").alias("n_tokens"),
        _sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        _sha(F.col("decoded")).alias("decoded_sha256"))


@_register
def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_register
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, f"warc-{os.urandom(8).hex()}")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.resolve(warc.read_archives(spark, path, with_payload=False))


@_register
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@_register
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: The rules of the contract.
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/"))


@_register
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


@_register
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.corpus_words(_table(spark, sf_dir, "documents"), misspell=31)
    return spelling_variants.spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


@_register
def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@_register
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))
