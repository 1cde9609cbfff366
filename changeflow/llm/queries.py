"""The operators applied to their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import chat, oracles
from changeflow.llm.common import table
from changeflow.llm.conversation_repair import damage, repair_report
from changeflow.llm.decontaminate import contamination
from changeflow.llm.fill_middle import fill_middle, restore
from changeflow.llm.language_id import language_ids
from changeflow.llm.licenses import license_scan
from changeflow.llm.line_dedup import dedup_lines
from changeflow.llm.lm_scores import lm_scores
from changeflow.llm.mixing import weighted_fair_mix
from changeflow.llm.quality import quality_report
from changeflow.llm.simhash import simhash_groups
from changeflow.llm.suffix_dedup import cut_repeats
from changeflow.llm.url_filter import filter_urls

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    log = chat.turn_events(turns.unionByName(chat.example_turns(spark)))
    return chat.digest(chat.format_messages(chat.final_messages(log)))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality_report(table(spark, sf_dir, "documents"), cleaned=True)
    return report.select("*", F.size("removed_lines").cast("long").alias("n_removed_lines"),
                         F.sha2("clean_text", 256).alias("clean_sha256")).drop("removed_lines", "clean_text")


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fair_mix(table(spark, sf_dir, "documents")).drop("first_finish")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), proximity=True)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle(table(spark, sf_dir, "documents"))
    return restore(made, carry=("n", "form", "prefix_chars", "middle_chars", "output_sha256")).drop("text")


def op12_repair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair_report(damage(turns), turns)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_ids(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_license_scan, op3_chat_format, op4_quality_rules,
                                    op5_lm_scores, op6_simhash_groups, op7_mix_sources, op8_decontaminate, op9_line_dedup,
                                    op10_url_filter, op11_fill_middle, op12_repair_turns, op13_language_id)}


def oracle_sql() -> dict[str, str]:
    return {"op4_quality_rules": oracles.quality_rules(), "op7_mix_sources": oracles.mix_sources(),
            "op8_decontaminate": oracles.decontaminated(), "op9_line_dedup": oracles.deduplicated_lines(),
            "op2_license_scan": oracles.license_scan(), "op10_url_filter": oracles.filtered_urls(),
            "op11_fill_middle": oracles.filled_middle(), "op12_repair_turns": oracles.repaired_conversations()}
