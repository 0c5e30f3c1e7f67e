"""Toxicity by a weighted lexicon matched with one Aho-Corasick pass over folded text.

Folding lower-cases, maps homoglyphs and digits or signs standing for letters to those letters, and
turns everything else into blanks, so every pattern starts at a word start. Patterns are word beginnings or whole words. Each
word scores its heaviest pattern unless an exception phrase covers it. A document's evidence is its heaviest word, the
logarithm of the sum, and the sum over the root of its length in words; a logistic curve turns it into a score.

The lexicon is learned from labels: the patterns that toxic documents hold much more often than clean ones. It and the curve are fitted
on at most about ``sample_rows`` labelled documents, the one bounded sample here and a parameter of ``fit`` (drawn by a hash of the id, the same for any
partitioning): one half gives the lexicon, the other the curve. Without labels a small fixed lexicon and curve apply. Scoring covers whole texts of all
documents; a null or empty text has no evidence and gets the curve's lowest score.
A null doc_id is scored like others. The time for a very long text grows with its length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import staged
from .common import freed
from .pii import FOLD

SAMPLE_ROWS = 24_000
PREFIXES = range(4, 11)
MIN_DOCS, MIN_WEIGHT = 4, 2.0

# Insults with weights, used where labels say nothing else; phrases in which they are harmless.
INSULTS = "idiot moron stupid dumb loser scum trash worthless pathetic disgusting clown imbecile bastard"
INSULT_WEIGHT = 3.0
EXCEPTIONS = ("clown fish", "trash can", "trash bin", "class clown", "loser bracket", "pathetic fallacy", "dumb waiter", "dumb bell")
CURVE = (-4.0, 0.8, 0.8, 0.3)
# Digits and signs that stand for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
SIGNS = {"$": "s", "@": "a"}
SIGN = re.compile(r"(?<!\S)[$@](?=[a-z])|(?<=[a-z0-9])[$@](?=[a-z0-9])")


class _Fold(dict):
    """Translation of one character; learned as characters come up."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        twin = FOLD.get(code, char).lower()
        out = LEET.get(twin, twin if twin.isalpha() else " ")
        self[code] = out if len(out) == 1 else " "
        return self[code]


def folded(text: str, table: dict | None = None) -> str:
    """Folded text between blanks."""
    table = _Fold() if table is None else table
    text = text.lower()
    if "$" in text or "@" in text:
        text = SIGN.sub(lambda m: SIGNS[m[0]], text)
    return f" {text.translate(table)} "


class Model(NamedTuple):
    lexicon: dict[str, float]  # pattern: weight; patterns start with a blank
    exceptions: tuple[str, ...]
    curve: tuple[float, ...]


class Matcher:
    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...]):
        import ahocorasick

        self.table, self.machine = _Fold(), ahocorasick.Automaton()
        for pattern, weight in lexicon.items():
            self.machine.add_word(pattern, (len(pattern), weight))
        for phrase in exceptions:
            pattern = folded(phrase)
            self.machine.add_word(pattern, (len(pattern), None))
        self.empty = not len(self.machine)
        if not self.empty:
            self.machine.make_automaton()

    def hits(self, text: str) -> tuple[list[float], int]:
        """Weight of each matched word, and the number of words."""
        plain = folded(text, self.table)
        words = len(plain.split())
        if self.empty:
            return [], words
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self.machine.iter(plain):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif weight > best.get(start, -math.inf):
                best[start] = weight
        # Words and phrases by start: a word is spared where a phrase before it reaches past it.
        spared.sort()
        found, k, reach = [], 0, -1
        for at in sorted(best):
            while k < len(spared) and spared[k][0] <= at:
                reach = max(reach, spared[k][1])
                k += 1
            if at >= reach:
                found.append(best[at])
        return found, words

    def evidence(self, text: str) -> tuple[float, float, float]:
        found, words = self.hits(text)
        total = sum(found)
        return max(found, default=0.0), math.log1p(max(total, 0.0)), total / math.sqrt(max(words, 1))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _features(text: str, table: dict) -> set[str]:
    out = set()
    for word in set(folded(text, table).split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in PREFIXES if n < len(word))
    return out


def _counts(sample: DataFrame, wanted: set[str] | None) -> DataFrame:
    """``(feature, n)``: documents that hold each feature, summed within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        table = _Fold()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = _features(text or "", table)
                for feature in found if wanted is None else found & wanted:
                    counts[feature] = counts.get(feature, 0) + 1
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["feature", "n"])

    return sample.select("text").mapInArrow(freed(run), "feature string, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))


def _lexicon(toxic: DataFrame, clean: DataFrame) -> dict[str, float]:
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        return {}
    # Bounded by the sample: each of its documents has a bounded number of frequent features.
    often = {r[0]: r[1] for r in _counts(toxic, None).where(F.col("n") >= MIN_DOCS).collect()}
    rare = {r[0]: r[1] for r in _counts(clean, set(often)).collect()}
    weight = {}
    for feature, n in often.items():
        w = math.log((n + 0.5) / (n_toxic + 1)) - math.log((rare.get(feature, 0) + 0.5) / (n_clean + 1))
        # Few documents are weak evidence.
        w -= 1.0 / math.sqrt(n)
        if w >= MIN_WEIGHT:
            weight[feature] = w
    kept: dict[str, float] = {}
    for feature in sorted(weight, key=lambda f: (len(f), f)):
        shorter = [feature[:n] for n in range(2, len(feature)) if feature[:n] in kept]
        if not any(kept[s] >= weight[feature] - 0.2 for s in shorter):
            kept[feature] = weight[feature]
    return kept


def _curve(evidence: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton steps that are halved until they lower the loss.

    The intercept starts at the share of toxic rows; slopes below zero are not let stand, so more evidence never lowers a score.
    """
    x = np.column_stack((np.ones(len(y)), evidence))
    ridge = np.array([1e-4, 0.1, 0.1, 0.1])
    loss = lambda w: np.logaddexp(0, x @ w).sum() - y @ (x @ w) + 0.5 * (ridge * w * w).sum()
    w = np.array([math.log(y.mean() / (1 - y.mean())), 0.0, 0.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge + 1e-6), slope)
        size = 1.0
        while size > 1e-6:
            new = w + size * step
            new[1:] = np.maximum(new[1:], 0)
            if loss(new) < loss(w) - 1e-9:
                break
            size /= 2
        else:
            break
        w = new
    return tuple(map(float, w))


def _evidence(docs: DataFrame, lexicon: dict, exceptions: tuple) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon, exceptions)
        for batch in batches:
            found = np.array([matcher.evidence(t or "") for t in batch.column(1).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found.T)], ["doc_id", "most", "total", "dense"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(freed(run), "doc_id bigint, most double, total double, dense double")


def fit(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn lexicon and curve from labelled documents that are not held out. Labels are 0 and 1; others, nulls and ids with
    both labels are left out. Of more than ``sample_rows`` labelled documents about as many are drawn; what they hold is not capped."""
    rows = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").select("doc_id", "toxic")
    share = min(1.0, sample_rows / max(1, rows.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20))
    rows = staged(rows.where(draw < int(share * (1 << 20))), "toxicity-labels")
    sample = staged(docs.select("doc_id", "text").join(rows, "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))), "toxicity-sample")
    first, second = sample.where("half = 0"), sample.where("half = 1")
    lexicon = {f" {word}": INSULT_WEIGHT for word in INSULTS.split()} | _lexicon(first.where("toxic = 1"), first.where("toxic = 0"))
    found = _evidence(second, lexicon, exceptions).join(rows, "doc_id").select("most", "total", "dense", "toxic").collect()  # bounded sample
    found = np.array([tuple(r) for r in found], float).reshape(-1, 4)
    enough = len(found) and 0 < found[:, 3].sum() < len(found)
    return Model(lexicon, exceptions, _curve(found[:, :3], found[:, 3]) if enough else CURVE)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row; score rises from 0 to 1."""
    a, b, c, d = model.curve
    line = a + b * F.col("most") + c * F.col("total") + d * F.col("dense")
    return _evidence(docs, model.lexicon, model.exceptions).select("doc_id", (1 / (1 + F.exp(-line))).alias("score"))
