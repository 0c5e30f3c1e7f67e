"""The corpus pipeline: five stages over ``documents``, each written and read again before the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ctxlake.llm import decontaminate, minhash, mixing, pii, toxicity
from ctxlake.llm.common import table
from ctxlake.runtime import staged

TOXIC_FROM = 0.3
BUDGET, REPEATS = 0.5, 4.0


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id is not listed; rows without doc_id stay."""
    listed = staged(ids.select("doc_id").distinct(), "pipeline-rejected")
    return docs.join(listed, "doc_id", "left_anti").select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``TOXIC_FROM`` stay."""
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return _without(docs, found.where(F.col("score") >= TOXIC_FROM))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with five-word shingles at similarity 0.8 or more, the smallest doc_id stays.

    Rows that share a doc_id are one document with several texts: they stay or go together, and of rows that repeat
    a text as well one stays, the least by a digest of its columns. Rows without doc_id, text or words stay.
    """
    found = minhash.near_duplicates(docs, shingle=5, percent=80)
    kept = _without(docs, found.where("NOT kept"))
    often = staged(kept.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "pipeline-repeated")
    if often.isEmpty():
        return kept
    row = F.struct(*kept.columns)
    again = kept.join(often, "doc_id", "left_semi").select(*kept.columns)
    again = again.groupBy("doc_id", "text").agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("row")).select("row.*")
    return kept.join(often, "doc_id", "left_anti").select(kept.columns).unionByName(again)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay unless a twentieth of their words or more lies in windows of benchmark items."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), window=13, share=20)
    return _without(docs, found.where("contaminated"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers are replaced by their kind; n_chars follows the new text. No document goes."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per draw of the mix with its position (pass, block_order, place); documents that are not drawn go. Texts stay in the stage before."""
    found = mixing.draws(mixing.mix(docs, budget_share=BUDGET, repeats=REPEATS))
    return found.select("doc_id", "source", "n_tokens", "weight", "passes", "copies", "block", "pass", "block_order", "place")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]

# Near duplicates, the learned lexicon and redaction are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
