"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every window of ``window`` words the least hash of its ``GRAM``-word grams is its fingerprint, so each
window shared by a document and a benchmark item shares a fingerprint. Fingerprints of both sides
are joined; every hit is extended up to a window both ways by comparing words, and a run of
``window`` equal words or more around it is a match. Items shorter than a window are one window of
their own length: they are winnowed in windows of that length, once for each length that occurs.

Words are runs of ASCII letters, digits and all non-ASCII characters, lower-cased in A-Z. Null and empty texts have no
words. Rows that share a doc_id share their hits; each row comes back. Rows of the benchmark that repeat an item count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import staged
from .common import lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 6
PLACE = 26


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _doubling(name: str, width: int) -> list[str]:
    """SQL steps that turn an array ``name`` into the least values of its runs of ``width`` (each step at least two long)."""
    steps, done = [], 1
    while done * 2 <= width:
        steps.append(f"zip_with({name}, slice({name}, {done + 1}, size({name})), (x, y) -> least(x, y))")
        done *= 2
    if width > done:
        steps.append(f"zip_with({name}, slice({name}, {width - done + 1}, size({name})), (x, y) -> least(x, y))")
    return steps


def fingerprints(rows: DataFrame, id_col: str, window: int) -> DataFrame:
    """``(id, hash, at)``: fingerprints of ``rows(id, words)`` and the 1-based word they start at.

    One number carries the upper bits of a gram's hash and its place below them, so the least of a window also
    names the first place it stands at. Places have ``PLACE`` bits; a hash cut short only adds hits that
    the comparison of words throws out.
    """
    gram = min(GRAM, window)
    width = window - gram + 1
    hashed = "transform(words, w -> xxhash64(w))"
    grams = f"transform(sequence(1, size(hashed) - {gram - 1}), i -> shiftleft(xxhash64(slice(hashed, i, {gram})), {PLACE}) | i)"
    rows = rows.where(F.size("words") >= window).select(id_col, F.expr(hashed).alias("hashed")).select(id_col, F.expr(grams).alias("least"))
    for step in _doubling("least", width):
        rows = rows.select(id_col, F.expr(step).alias("least"))
    # Windows that reach over the end stand last; they are cut off.
    distinct = f"explode(array_distinct(slice(least, 1, size(least) - {width - 1})))"
    return rows.select(id_col, F.expr(distinct).alias("least")).select(
        id_col, F.expr(f"shiftrightunsigned(least, {PLACE})").alias("hash"), F.expr(f"CAST(least & {(1 << PLACE) - 1} AS INT)").alias("at")
    )


def _matches(docs: DataFrame, items: DataFrame, window: int, whole: bool) -> DataFrame:
    """``(doc_id, item_id, start, length)``: runs of equal words that hold a window, some of them more than once."""
    items = items.where(F.size("words") == window) if whole else items.where(F.size("words") >= window)
    # Written, so that joins choose by its size on disk.
    probe = staged(fingerprints(items, "item_id", window).withColumnsRenamed({"at": "item_at"}), "decontaminate-probe")
    hits = staged(fingerprints(docs.withColumn("words", words(F.col("text"))), "doc_id", window).join(probe, "hash").drop("hash"), "decontaminate-hits")
    hit_docs = staged(hits.select("doc_id").distinct(), "decontaminate-documents")
    texts = docs.join(hit_docs, "doc_id", "left_semi").select("doc_id", words(F.col("text")).alias("words")).distinct()
    gram = min(GRAM, window)
    reach = window - gram
    found = hits.join(items.select("item_id", F.col("words").alias("item_words")), "item_id").select(
        "doc_id", "item_id", "at", "item_at", F.expr(f"slice(item_words, greatest(1, item_at - {reach}), {2 * reach + gram})").alias("item_words")
    )
    # ``shift``: the words around the hit in the item start so much before it.
    found = found.withColumn("shift", F.expr(f"least(item_at - 1, {reach})")).join(texts, "doc_id")
    equal = f"transform(sequence(-shift, {reach + gram - 1}), d -> coalesce(get(item_words, shift + d) = get(words, at - 1 + d), false))"
    found = found.select("doc_id", "item_id", "at", "shift", F.expr(equal).alias("equal"))
    left = "shift - coalesce(aggregate(slice(equal, 1, shift), 0, (n, e) -> if(e, n + 1, 0)), 0)"
    right = f"aggregate(slice(equal, shift + 1, {reach + gram}), struct(0 AS n, true AS go), (s, e) -> struct(if(s.go AND e, s.n + 1, s.n) AS n, s.go AND e AS go), s -> s.n)"
    found = found.select("doc_id", "item_id", "at", "shift", F.expr(left).alias("from_shift"), F.expr(right).alias("right"))
    found = found.select("doc_id", "item_id", F.expr("at - (shift - from_shift)").alias("start"), F.expr("right + shift - from_shift").alias("length"))
    return found.where(f"length >= {window}")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """Words of each document inside windows of benchmark items.

    ``docs(doc_id, text)``, ``benchmark(item_id, text)``. Returns one row per input row: ``doc_id, n_words, n_hit,
    n_items, items_sha256, contaminated``; contaminated is ``n_hit > 0 and share * n_hit >= n_words``. A null doc_id has no hits.
    """
    docs = docs.select("doc_id", "text")
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where("item_id IS NOT NULL AND size(words) > 0").distinct()
    items = staged(items, "decontaminate-items")
    short = [r[0] for r in items.where(F.size("words") < window).select(F.size("words")).distinct().collect()]  # at most window - 1 numbers
    known = docs.where("doc_id IS NOT NULL")
    found = _matches(known, items, window, whole=False)
    for length in sorted(short):
        found = found.unionByName(_matches(known, items, length, whole=True))
    found = staged(found.distinct(), "decontaminate-matches")
    hit = (
        found.select("doc_id", F.expr("explode(sequence(start, start + length - 1))").alias("at")).distinct().groupBy("doc_id").agg(F.count("*").alias("n_hit"))
    )
    named = found.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    marked = hit.join(named, "doc_id")
    counted = docs.select("doc_id", F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    out = counted.join(marked, "doc_id", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
    )
    return out.withColumn("contaminated", F.expr(f"n_hit > 0 AND {share} * n_hit >= n_words"))
