"""The registered queries of this folder and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import chat, collocations, decontaminate, langid, manifest_tree, minhash, mixing, pii, spotsigs, substring, suffix_dedup, tokens, toxicity
from .common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_chat_format(spark, sf_dir):
    """Every turn of every conversation, repaired, with its piece of the rendered text."""
    found = chat.repair(table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "turn", "role", "fixed_role", "action", "inserted", "piece")


@query
def op3_token_counts(spark, sf_dir):
    """Tokens of each line; a token over a boundary counts where it starts."""
    return tokens.section_tokens(table(spark, sf_dir, "documents"), tokens.read_ranks(spark), rule="first")


@query
def op5_spotsigs(spark, sf_dir):
    return spotsigs.edited_likeness(table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", F.expr("CAST(score >= 0.3 AS INT)").alias("predicted"))


def _joined(spans: str):
    return F.array_join(F.expr(f"transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end))"), ",")


@query
def op7_pii(spark, sf_dir):
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


@query
def op8_suffix_array(spark, sf_dir):
    found = suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("bigint").alias("n_spans"), "kept_sha256")


@query
def op9_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


@query
def op10_substring(spark, sf_dir):
    found = substring.repeated_words(table(spark, sf_dir, "documents"), words=35)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


BUDGET, REPEATS = 0.5, 4.0


@query
def op2_mixing(spark, sf_dir):
    """Half of all tokens, small sources raised as far as four passes over one allow."""
    return mixing.mix(table(spark, sf_dir, "documents"), budget_share=BUDGET, repeats=REPEATS)


ORACLE["op2_mixing"] = mixing.mixing_sql(budget_share=BUDGET, repeats=REPEATS)


@query
def op4_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, share=20)


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"), most=4, least=30, best=2000, share=80)


ORACLE["op11_collocations"] = collocations.collocations_sql(least=30, best=2000, share=80)


@query
def op12_manifest(spark, sf_dir):
    found = manifest_tree.manifest(table(spark, sf_dir, "documents"), *manifest_tree.tampering())
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


ORACLE["op12_manifest"] = manifest_tree.manifest_sql()


@query
def op13_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_words", "switches")
