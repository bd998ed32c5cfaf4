"""Registered queries of the corpus operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm import fim, html_tree, licenses, minhash, mixing, packing, quality, term_pipeline, tokens, toxicity, urls, vptree, warc
from freightlens.llm.common import Scratch, read_table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"), words=2, percent=80)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic").where(~toxicity.in_fold(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", toxicity.in_fold(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"),
                         (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return html_tree.extract(pages, Scratch(spark, "html")).withColumn("n_chars", F.length("text").cast("long"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents", "doc_id", "text")).drop("blocks")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(read_table(spark, sf_dir, "documents"), mixing.WEIGHTS, Scratch(spark, "mixing"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"), Scratch(spark, "quality"))
    return judged.select("doc_id", *[F.col(f"quality_m.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                         F.col("quality_base_failed").alias("base_failed"), F.col("quality_kept").alias("kept"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    back = tokens.round_trip(docs, public_tokenizers.path(TOKENIZER), END_ID)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0, Scratch(spark, "nearest"), k=20)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER), END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
                         "context", "step_group")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return urls.judge(pages, urls.fit(pages)).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_pipeline.search(read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark", "item_id", "text"),
                                Scratch(spark, "search"), k=50)


def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "warc").path("archive")
    warc.write(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), folder, min_bytes=0)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(read_table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "fim")
    back = fim.restore(cut, F.col("fim.output"), F.col("fim.form"))
    return back.select("doc_id", *[F.col(f"fim.{c}").alias(c) for c in ("n", "form", "prefix_chars", "middle_chars", "output_sha256")],
                       F.sha2("restored", 256).alias("restored_sha256"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_minhash_dedup, op2_toxicity, op3_html_main_text, op4_license_scan, op5_source_mix,
                                    op6_quality_rules, op7_token_files, op8_nearest, op9_packing, op10_url_filter,
                                    op11_lexical_search, op12_warc_archive, op13_fill_in_middle)}
