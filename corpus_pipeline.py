"""The corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, mixing.

Each stage reads all that the one before kept, and all but the last return the columns
of ``documents``. Stages hand over Parquet in the cluster's shared folder.

Defined cases: extra columns are carried through; an empty table stays empty; rows with a null
text fail the quality rules. A stage that takes lines out of a text sets ``n_chars`` to what is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import NOT_BLANK, materialize, table
from changeflow.llm.decontaminate import contamination
from changeflow.llm.line_dedup import dedup_lines
from changeflow.llm.mixing import weighted_fair_mix
from changeflow.llm.quality import quality_report
from changeflow.llm.simhash import one_per_group


def _with_row(docs: DataFrame) -> DataFrame:
    """The columns that operators read, with the whole row carried along as ``_row``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return docs.select(F.col("doc_id"), F.col("text"), F.col("source"), row)


def _with_text(out: DataFrame, docs: DataFrame, text: str, changed: Column) -> DataFrame:
    """The carried rows with the text of column ``text`` in place of their own; ``n_chars``, where there is one, follows it."""
    new = F.col("_row").withField("text", F.col(text))
    if "n_chars" in docs.columns:
        length = F.char_length(text).cast(docs.schema["n_chars"].dataType)
        new = new.withField("n_chars", F.when(changed, length).otherwise(F.col("_row.n_chars")))
    return out.select(new.alias("_row")).select("_row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their failing lines."""
    out = quality_report(_with_row(docs), keep=("_row",), cleaned=True).where("kept")
    return _with_text(out, docs, "clean_text", F.size("removed_lines") > 0)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their later repeated runs of lines; a document that loses its last word goes."""
    out = dedup_lines(_with_row(docs), keep=("_row",))
    out = out.where((F.col("n_removed") == 0) | F.rlike("kept_text", F.lit(NOT_BLANK)))
    return _with_text(out, docs, "kept_text", F.col("n_removed") > 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest id."""
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window."""
    out = contamination(_with_row(docs), table(spark, sf_dir, "benchmark"), keep=("_row",))
    return out.where(~F.col("contaminated")).select("_row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often (``copies``) and their words taken (``taken``)."""
    out = weighted_fair_mix(_with_row(docs), carry=("_row",)).where("copies > 0")
    new = [c for c in ("copies", "taken", "target") if c not in docs.columns]
    return out.select("_row.*", *new)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SimHash needs XXH64 and bit counts per shingle, which SQL can't express; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
