"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import conversation, decontaminate, html_text, language_model, mixing, packing, periodic, pii, quality, simhash, tokens, toxicity, warc
from ledgerline.llm.common import SPACES, WORD, table
from ledgerline.llm.oracle import ORACLE_SQL
from ledgerline.session import scratch_path


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def token_output(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the files into the shared work folder and read them back."""
    folder = scratch_path(spark, "tokens")
    manifest = tokens.write_tokens(docs, folder, tokens.TokenFormat(tokenizer or tokenizer_path()))
    return tokens.read_tokens(manifest, folder)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(spark, table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(manifest, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"),
                                              table(spark, sf_dir, "benchmark"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.language_model_report(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.html_report(table(spark, sf_dir, "pages"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage that operator 11 is to repair, by crc32 of
    ``conv_id:turn``: rows with 0 ``copies`` (dropped), no text, no end
    marks, 2 ``copies``, or the user's role."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", as_text("role").alias("role"),
                                as_text("text").alias("text"), kind.alias("kind"))
    text = (F.when(F.col("kind") == 1, F.lit(""))
            .when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.repair_report(damaged(table(spark, sf_dir, "conversations")), "copies")


def with_repeats(docs: DataFrame) -> DataFrame:
    """The repeats that operator 12 is to find: where h, the crc32 of the
    decimal doc_id (null: of no text), is a multiple of 10, the words from
    number a on are the first p of them over and over."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.when((F.col("h") % 10 == 0) & (F.rtrim("text", F.lit(SPACES)) != ""),
                   F.regexp_extract_all("text", F.lit(f"({WORD})"), 1))
    g = F.expr("h div 10")
    rows = (docs.select("doc_id", "text", h.alias("h")).withColumn("words", words)
            .withColumn("n", F.size("words")).withColumn("g", g)
            .withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
            .withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)")))
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")),
                                    F.expr("CAST((n - a) div p + 1 AS INT)")))
    text = F.array_join(F.concat(F.slice("words", 1, F.col("a")), F.slice(tail, 1, F.col("n") - F.col("a"))), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.runs_report(with_repeats(table(spark, sf_dir, "documents")))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    fmt = packing.PackFormat(tokenizer_path("byte_bpe_50k.json"))
    return packing.pack(table(spark, sf_dir, "documents"), fmt).drop("ids")


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": op1_token_output,
    "op2_toxicity": op2_toxicity,
    "op3_quality_rules": op3_quality_rules,
    "op4_warc": op4_warc,
    "op5_decontamination": op5_decontamination,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_mixing": op7_mixing,
    "op8_language_model": op8_language_model,
    "op9_pii": op9_pii,
    "op10_html_text": op10_html_text,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_best_fit_packing": op13_best_fit_packing,
}
