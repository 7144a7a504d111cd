"""The registered queries of this subpackage, each an operator over its whole table."""

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm import (
    chat,
    line_dedup,
    ngram_join,
    packing,
    periodic_runs,
    pieces,
    pii,
    quality,
    secret_scan,
    suffix_dedup,
    topk,
    url_filters,
    whitening,
)
from clickflow.llm.common import read_table, ship


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read_table(spark, sf_dir, "documents"), alike="lang")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.secret_spans(documents).select("doc_id", "__spans")
    base = F.filter("__spans", lambda s: s["rule"] < len(secret_scan.BASE_RULES))
    counts = [
        secret_scan.span_count(F.col("__spans"), i).alias(f"n_{rule.kind}")
        for i, rule in enumerate(secret_scan.BASE_RULES)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("__spans")).alias("spans"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    cleaned = line_dedup.line_dedup(documents)
    return cleaned.select("doc_id", "source", F.col("__removed").alias("n_removed"), "text")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    kinds = "conv_id long, turn long, role string, text string"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], kinds)
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(conversations.unionByName(extra))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    edges = url_filters.page_edges(pages)
    judged = url_filters.url_filter(pages.drop("html"), url_filters.rule_table(spark), edges)
    return judged.select(
        "page_id",
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__rule.rule").alias("rule"),
        F.col("__verdict").alias("verdict"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_measures(read_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents")).drop("kept")


def planted(doc_id, words: list) -> list:
    """A tenth of the documents, by the checksum of their id, get a periodic end; a null id is left alone."""
    mark = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if mark % 10 or not words:
        return words
    start = mark // 10 % len(words)
    period = 1 + (len(words) - start) // (3 + mark // 10 % 8)
    return [word if i < start else words[start + (i - start) % period] for i, word in enumerate(words)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(read_table(spark, sf_dir, "documents"), arrange=planted)
    # Of runs sorted by start and period the first one that no later one exceeds.
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda top, run: F.when(run["length"] * top["period"] > top["length"] * run["period"], run).otherwise(top),
    )
    shown = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(shown, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii_spans(read_table(spark, sf_dir, "documents"))
    base = F.filter("__spans", lambda s: s["rule"] < len(pii.BASE_RULES))
    counts = [pii.span_count(F.col("__spans"), i).alias(f"n_{rule.kind}") for i, rule in enumerate(pii.BASE_RULES)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.col("__spans")).alias("spans"),
        F.array_join(F.transform("__spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def _shipping(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    return run


def queries() -> dict:
    named = (
        op1_topk_search,
        op2_sentencepiece,
        op3_packing,
        op4_secret_scan,
        op5_line_dedup,
        op6_ngram_join,
        op7_chat_format,
        op8_url_filter,
        op9_quality_rules,
        op10_suffix_dedup,
        op11_periodic_runs,
        op12_pii,
        op13_whitening,
    )
    return {function.__name__: _shipping(function) for function in named}
