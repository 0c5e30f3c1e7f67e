"""Mixing sources to target weights, in DataFrame functions only.

Token shares of the sources are raised to an exponent and normalised. The exponent is found by bisection:
the largest one whose weights have the wanted entropy, or repeat no source more often than allowed;
six halvings are tried in one job over all sources. A source's share of the budget is realised as whole
passes over it and one part of a pass: documents lie in blocks by digest, the blocks of a pass come in an order of
their own, and the part ends in the first block that the budget does not cover, after its first documents by
digest. Running sums are taken in two steps, over bins of blocks and within bins, so no task
holds a whole source.

A document is drawn where the running sum before it is below the budget. Null source is a source of its
own; null or empty texts have no tokens and are drawn with every whole pass. Rows that share a doc_id are drawn alike.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import staged

TOKEN = r"[^\x20\x09-\x0D]+"
BINS = 256
STEPS = 9  # jobs of six halvings: 54 bits


def token_count(text: Column) -> Column:
    """White-space tokens."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("bigint")


def _weights(totals: DataFrame, exponents: Column | None, exponent: float | None = None) -> DataFrame:
    """Normalised weights of all sources, for one exponent or for each of an array."""
    every = totals.where("tokens > 0").select("source", "tokens", (F.explode(exponents) if exponent is None else F.lit(exponent)).alias("exponent"))
    every = every.withColumn("raised", F.exp(F.col("exponent") * F.log("tokens")))
    if exponent is not None:
        whole = every.agg(F.sum("raised").alias("whole"))
        return every.join(F.broadcast(whole)).withColumn("weight", F.col("raised") / F.col("whole"))  # one row
    return every


def bisect_exponent(totals: DataFrame, budget: float, entropy: float | None, repeats: float | None) -> float:
    """Largest exponent in [0, 1] whose weights reach ``entropy`` (a share of its largest value), or, with ``repeats``, the
    smallest that draws no source more often than that. 0 or 1 where every or no exponent does."""
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        tried = [low + (high - low) * k / 64 for k in range(0, 65)]
        every = _weights(totals, F.array(*map(F.lit, tried)))
        found = every.groupBy("exponent").agg(
            F.count("*").alias("n"),
            F.sum("raised").alias("whole"),
            F.sum(F.col("raised") * F.log("raised")).alias("logs"),
            F.max(F.col("raised") / F.col("tokens")).alias("most"),
        )
        if entropy is not None:
            # Entropy falls as the exponent grows.
            good = F.log("whole") - F.col("logs") / F.col("whole") >= entropy * F.log("n") - 1e-12
            edge = found.where(good).agg(F.max("exponent")).first()[0]
        else:
            good = F.col("most") / F.col("whole") * budget <= repeats
            edge = found.where(good).agg(F.min("exponent")).first()[0]
        if edge is None:
            return 0.0 if entropy is not None else 1.0
        if edge == (1.0 if entropy is not None else 0.0):
            return edge
        at = tried.index(edge)
        low, high = (tried[at], tried[min(at + 1, 64)]) if entropy is not None else (tried[max(at - 1, 0)], tried[at])
    return low if entropy is not None else high


def mix(
    docs: DataFrame, *, budget_share: float = 1.0, entropy: float | None = None, repeats: float | None = None,
    block_tokens: int = 1 << 16, seed: str = "mix",
) -> DataFrame:
    """How often each document is drawn.

    ``docs(doc_id, text, source)``; the budget is ``budget_share`` times all tokens. Exactly one of ``entropy`` (share of the largest
    entropy) and ``repeats`` (draws of the most repeated source) is the target. Returns one row per input row: ``doc_id, source, n_tokens,
    weight, passes, copies, block``: whole passes over the source, draws of the document, and its block.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("give either entropy or repeats")
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")))
    rows = docs.select("doc_id", "source", token_count(F.col("text")).alias("n_tokens"), key.alias("digest"))
    rows = staged(rows, "mixing-rows")
    totals = staged(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")), "mixing-sources")
    budget = budget_share * (totals.agg(F.sum("tokens")).first()[0] or 0)
    exponent = bisect_exponent(totals, budget, entropy, repeats)
    weights = _weights(totals, None, exponent).select(F.col("source").alias("of"), "weight")
    plan = totals.join(weights, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source",
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("bigint").alias("blocks"),
        F.coalesce(F.floor(F.col("weight") * budget / F.col("tokens")), F.lit(0)).cast("bigint").alias("passes"),
        F.coalesce(F.col("weight") * budget, F.lit(0.0)).alias("share"),
        "tokens",
    )
    plan = staged(plan.withColumn("rest", F.floor(F.col("share") - F.col("passes") * F.col("tokens")).cast("bigint")), "mixing-plan")
    plan = plan.withColumnRenamed("source", "of")
    # A block number from the first 15 hexadecimal digits, the order of blocks in the part pass from a digest of their own.
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "block", F.pmod(F.conv(F.substring("digest", 1, 15), 16, 10).cast("bigint"), F.col("blocks"))
    )
    placed = placed.withColumn("order", F.md5(F.concat_ws("|", F.lit(seed), F.coalesce("source", F.lit("")), (F.col("passes") + 1).cast("string"), F.col("block").cast("string"))))
    blocks = placed.groupBy("source", "block", "order").agg(F.sum("n_tokens").alias("tokens"))
    blocks = staged(blocks.withColumn("bin", F.substring("order", 1, 2)), "mixing-blocks")
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    bins = blocks.groupBy("source", "bin").agg(F.sum("tokens").alias("tokens"))
    bins = bins.select(F.col("source").alias("of"), F.col("bin").alias("of_bin"), F.coalesce(F.sum("tokens").over(before("source").orderBy("bin")), F.lit(0)).alias("base"))
    blocks = blocks.join(bins, F.col("source").eqNullSafe(F.col("of")) & (F.col("bin") == F.col("of_bin"))).select(
        F.col("source").alias("of"), F.col("block").alias("of_block"),
        (F.col("base") + F.coalesce(F.sum("tokens").over(before("source", "bin").orderBy("order", "block")), F.lit(0))).alias("base"),
    )
    placed = placed.drop("of", "order").join(blocks, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block")))
    inside = F.sum("n_tokens").over(Window.partitionBy("source", "block").orderBy("digest", "doc_id").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    # Rows that share a doc_id have one digest: the running sum before them is the same for all.
    peers = F.sum("n_tokens").over(Window.partitionBy("source", "block", "digest", "doc_id"))
    placed = placed.withColumn("reached", F.col("base") + inside - peers)
    return placed.select(
        "doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"), "passes",
        (F.col("passes") + F.when((F.col("rest") > 0) & (F.col("n_tokens") > 0) & (F.col("reached") < F.col("rest")), 1).otherwise(0)).cast("bigint").alias("copies"),
        "block",
    )


def draws(found: DataFrame, seed: str = "mix") -> DataFrame:
    """One row per draw of ``mix`` with the same seed: its columns, and ``pass, block_order, place``.

    Within a source, draws come in the order of these three: passes from 1, the blocks of a pass in an order of their own, documents
    of a block by digest. Documents that are not drawn are left out.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")))
    placed = found.where("copies > 0").withColumn("place", F.row_number().over(Window.partitionBy("source", "block").orderBy(digest, "doc_id", "n_tokens")).cast("bigint"))
    every = placed.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    order = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce("source", F.lit("")), F.col("pass").cast("string"), F.col("block").cast("string")))
    return every.select(*found.columns, "pass", order.alias("block_order"), "place")


def mixing_sql(documents: str = "documents", *, budget_share: float, repeats: float, block_tokens: int = 1 << 16, seed: str = "mix") -> str:
    """``mix`` for a repetition limit in DuckDB SQL over a relation ``documents``: the same bisection, as a recursive query."""
    return f"""
WITH RECURSIVE mix_rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens, md5(concat_ws('|', '{seed}', doc_id::VARCHAR)) AS digest FROM {documents}),
totals AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM mix_rows GROUP BY source),
budget AS (SELECT {budget_share} * sum(tokens)::DOUBLE AS b FROM totals),
search(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN good THEN low ELSE (low + high) / 2 END, CASE WHEN good THEN (low + high) / 2 ELSE high END FROM (
    SELECT step, low, high, (SELECT max(exp((low + high) / 2 * ln(tokens)) / tokens) / sum(exp((low + high) / 2 * ln(tokens))) FROM totals WHERE tokens > 0) * (SELECT b FROM budget) <= {repeats} AS good
    FROM search WHERE step < {6 * STEPS})),
ends AS (SELECT (SELECT max(1.0 / tokens) / count(*) FROM totals WHERE tokens > 0) * (SELECT b FROM budget) <= {repeats} AS all_good),
chosen AS (SELECT CASE WHEN (SELECT all_good FROM ends) THEN 0.0::DOUBLE ELSE (SELECT high FROM search WHERE step = {6 * STEPS}) END AS e),
weights AS (SELECT source, tokens, exp(e * ln(tokens)) / (SELECT sum(exp(e * ln(tokens))) FROM totals WHERE tokens > 0) AS weight FROM totals, chosen WHERE tokens > 0),
plan AS (
  SELECT t.source, coalesce(w.weight, 0) AS weight, greatest(1, ceil(t.tokens / {block_tokens}.0))::BIGINT AS blocks,
    coalesce(floor(w.weight * b / t.tokens), 0)::BIGINT AS passes, coalesce(w.weight * b, 0) AS share, t.tokens
  FROM totals t LEFT JOIN weights w ON w.source IS NOT DISTINCT FROM t.source, budget),
planned AS (SELECT *, floor(share - passes * tokens)::BIGINT AS rest FROM plan),
placed AS (
  SELECT r.*, p.weight, p.passes, p.rest, ('0x' || substr(digest, 1, 15))::BIGINT % blocks AS block FROM mix_rows r JOIN planned p ON p.source IS NOT DISTINCT FROM r.source),
ordered AS (SELECT *, md5(concat_ws('|', '{seed}', coalesce(source, ''), (passes + 1)::VARCHAR, block::VARCHAR)) AS ord FROM placed),
running AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY substr(ord, 1, 2), ord, block, digest, doc_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    - sum(n_tokens) OVER (PARTITION BY source, block, digest, doc_id) AS reached FROM ordered)
SELECT doc_id, source, n_tokens, round(weight, 9) AS weight, passes,
  (passes + CASE WHEN rest > 0 AND n_tokens > 0 AND reached < rest THEN 1 ELSE 0 END)::BIGINT AS copies, block
FROM running"""
