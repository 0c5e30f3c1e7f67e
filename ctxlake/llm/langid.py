"""Language of text by a linear-chain conditional random field over words.

A word is a run of ASCII letters and non-ASCII characters with a letter in it, lower-cased. Its features are hashed: byte n-grams between word
marks (those at a mark are prefixes and suffixes), the whole word, and the language that a learned lexicon gives it. A chain
ends at a line feed or one of ``.!?``, at the end of the text, and after ``CHAIN`` words. Emissions and transitions are learned together; the
forward-backward pass gives each word of mixed text a probability for each language, whose mean over a text decides its
language.

The forward-backward pass runs over all chains of a chunk of text at once, as products of small matrices in blocks; a chain starts with a
matrix of equal rows, so nothing crosses it. Texts longer than a chunk are cut at the last character outside words before each
``CHUNK_BYTES`` bytes, so they are cut alike in any partitioning.

Learning takes a bounded sample: about ``rows`` documents of each language, drawn by a hash of the id, and of each at most ``runs`` runs of ``run_words``
words spread over the whole text. Runs of different documents are joined in pairs, which teaches transitions. Labelling covers
whole texts of all rows. A null text, or one without a letter, is ``und`` with score 0; so is everything where no language could be learned.
Rows that repeat a doc_id are predicted one by one and learned from once. A null doc_id is not held out and not learned from. Ties go to the
language that sorts first. Extra columns take no part. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import staged
from .common import Powers, chunks, texts

ROWS, RUNS, RUN_WORDS = 300, 8, 12
BUCKETS = 1 << 16
GRAMS = (2, 3, 4, 5)
CHUNK_BYTES = 1 << 21
CHAIN = 4096
BLOCK = 64
ROUNDS, RATE, RIDGE = 60, 0.2, 1e-3
LEXICON_SHARE, LEXICON_TIMES = 0.9, 5
WORD = re.compile("[A-Za-z\u0080-\U0010ffff]+")

_INSIDE = np.zeros(256, bool)
_INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True
_ENDS = np.zeros(256, bool)
_ENDS[list(b"\n.!?")] = True


class Model(NamedTuple):
    langs: list[str]
    weights: np.ndarray  # (BUCKETS + languages + 1, languages)
    steps: np.ndarray  # probabilities up to scale, from row to column
    first: np.ndarray
    lexicon: np.ndarray  # sorted hashes of words
    lexicon_langs: np.ndarray


class Features:
    """Hashed features of distinct words, word after word."""

    def __init__(self):
        self.powers = Powers(0x2545F4914F6CDD1D)

    def of(self, words: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """For each kind of n-gram ``(bucket of each, first of each word)``, and a hash of each word."""
        body, at = texts(words)
        n, sizes = len(words), np.diff(at)
        marked_at = at + 2 * np.arange(n + 1)
        marked = np.zeros(int(marked_at[-1]), np.uint64)
        place = np.arange(len(body)) + 2 * np.repeat(np.arange(n), sizes) + 1
        marked[place] = body.astype(np.uint64) + np.uint64(3)
        marked[marked_at[:-1]], marked[marked_at[1:] - 1] = 1, 2
        out = []
        for g in GRAMS:
            per = np.maximum(sizes + 2 - g + 1, 0)
            first = np.zeros(n + 1, np.int64)
            np.cumsum(per, out=first[1:])
            starts = np.arange(first[-1]) - np.repeat(first[:-1], per) + np.repeat(marked_at[:-1], per)
            out.append((self._bucket(self.powers.spans(marked, starts, starts + g)), first))
        whole = self.powers.spans(marked, marked_at[:-1], marked_at[1:])
        out.append((self._bucket(whole ^ np.uint64(0x5555555555555555)), np.arange(n + 1)))
        return out, whole

    @staticmethod
    def _bucket(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(40)).astype(np.int64) % BUCKETS


def _lexicon_feature(model: Model, whole: np.ndarray) -> np.ndarray:
    """Row of the weights for what the lexicon says of each word; the last one for words it does not have."""
    none = np.full(len(whole), BUCKETS + len(model.langs))
    if not len(model.lexicon):
        return none
    at = np.minimum(np.searchsorted(model.lexicon, whole), len(model.lexicon) - 1)
    return np.where(model.lexicon[at] == whole, BUCKETS + model.lexicon_langs[at], none)


def _emissions(model: Model, features: Features, words: pa.Array) -> np.ndarray:
    kinds, whole = features.of(words)
    out = model.weights[_lexicon_feature(model, whole)].astype(np.float64)
    for buckets, first in kinds:
        total = np.zeros((len(buckets) + 1, len(model.langs)))
        np.cumsum(model.weights[buckets], axis=0, out=total[1:])
        out += total[first[1:]] - total[first[:-1]]
    return out


def posteriors(emissions: np.ndarray, opens: np.ndarray, steps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probabilities of the labels of each word by forward-backward; ``opens`` marks the first words of chains."""
    n, size = emissions.shape
    psi = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    blocks = -(-n // BLOCK)
    moves = np.broadcast_to(np.eye(size), (blocks * BLOCK, size, size)).copy()
    moves[:n] = np.where(opens[:, None, None], first[None, None, :], steps[None]) * psi[:, None, :]
    moves = moves.reshape(blocks, BLOCK, size, size)
    whole = np.broadcast_to(np.eye(size), (blocks, size, size))
    for k in range(BLOCK):
        whole = whole @ moves[:, k]
        whole /= whole.max(axis=(1, 2), keepdims=True)
    into, out_of = np.ones((blocks, size)), np.ones((blocks, size))
    for b in range(1, blocks):
        into[b] = into[b - 1] @ whole[b - 1]
        into[b] /= into[b].max()
    for b in range(blocks - 2, -1, -1):
        out_of[b] = whole[b + 1] @ out_of[b + 1]
        out_of[b] /= out_of[b].max()
    found = np.empty((blocks, BLOCK, size))
    v = into
    for k in range(BLOCK):
        v = np.einsum("bi,bij->bj", v, moves[:, k])
        v /= v.max(axis=1, keepdims=True)
        found[:, k] = v
    v = out_of
    for k in range(BLOCK - 1, -1, -1):
        found[:, k] *= v
        v = np.einsum("bij,bj->bi", moves[:, k], v)
        v /= v.max(axis=1, keepdims=True)
    found = found.reshape(-1, size)[:n]
    return found / found.sum(axis=1, keepdims=True)


class Labeller:
    def __init__(self, model: Model):
        self.model, self.features = model, Features()

    def label(self, data: np.ndarray, offsets: np.ndarray):
        """Byte starts and ends, chain numbers and label probabilities of all words of some rows."""
        inside = _INSIDE[data]
        opened, closed = inside.copy(), inside.copy()
        opened[1:] &= ~inside[:-1]
        closed[:-1] &= ~inside[1:]
        full = offsets[:-1] < offsets[1:]
        heads, tails = offsets[:-1][full], offsets[1:][full] - 1
        opened[heads], closed[tails] = inside[heads], inside[tails]
        starts, ends = np.flatnonzero(opened), np.flatnonzero(closed) + 1
        at = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=at[1:])
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data[inside])]).dictionary_encode()
        words = pc.utf8_lower(coded.dictionary.cast(pa.large_string()))
        real = pc.match_substring_regex(words, r"\pL").to_numpy(zero_copy_only=False)
        codes = coded.indices.to_numpy()
        keep = real[codes]
        starts, ends, codes = starts[keep], ends[keep], codes[keep]
        marks = _ENDS[data].astype(np.int64)
        marks[heads] += 1
        chain = np.cumsum(marks)[starts]
        if not len(starts):
            return starts, ends, chain, np.zeros((0, len(self.model.langs)))
        fresh = np.flatnonzero(np.concatenate(([True], chain[1:] != chain[:-1])))
        within = np.arange(len(chain)) - np.repeat(fresh, np.diff(np.append(fresh, len(chain))))
        opens = within % CHAIN == 0
        emissions = _emissions(self.model, self.features, words)[codes]
        return starts, ends, np.cumsum(opens), posteriors(emissions, opens, self.model.steps, self.model.first)

    def parts(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Chunks ``(first row, byte of it the chunk starts at, bytes, offsets)``; a long text comes in several."""
        body, bounds = texts(column)
        for row, _, data, offsets in chunks(body, bounds, CHUNK_BYTES):
            at = 0
            while len(offsets) == 2 and len(data) - at > CHUNK_BYTES:
                size, cut = CHUNK_BYTES, np.zeros(0, int)
                while not len(cut) and at + size < len(data):
                    cut = np.flatnonzero(~_INSIDE[data[at : at + size]])
                    size *= 2
                step = int(cut[-1]) + 1 if len(cut) else len(data) - at
                yield row, at, data[at : at + step], np.array([0, step])
                at += step
            yield row, at, data[at:], offsets if at == 0 else np.array([0, len(data) - at])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, n_words, switches`` of each row of ``docs(doc_id, text)``; switches are changes of language within chains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller, langs = Labeller(model), np.array([*model.langs, "und"], object)
        for batch in batches:
            rows = batch.num_rows
            sums, counts, switches = np.zeros((rows, len(model.langs))), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            for row, _, data, offsets in labeller.parts(batch.column(1)) if model.langs else ():
                starts, _, chain, found = labeller.label(data, offsets)
                of = row + np.searchsorted(offsets, starts, "right") - 1
                counts += np.bincount(of, minlength=rows)
                for j in range(len(model.langs)):
                    sums[:, j] += np.bincount(of, found[:, j], minlength=rows)
                best = found.argmax(axis=1) if len(found) else np.zeros(0, int)
                turn = (best[1:] != best[:-1]) & (chain[1:] == chain[:-1])
                switches += np.bincount(of[1:][turn], minlength=rows)
            known = counts > 0
            best = sums.argmax(axis=1) if model.langs else np.zeros(rows, int)
            score = np.where(known, sums.max(axis=1, initial=0.0) / np.maximum(counts, 1), 0.0)
            lang = langs[np.where(known, best, len(model.langs))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(counts), pa.array(switches)],
                ["doc_id", "lang_pred", "score", "n_words", "switches"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double, n_words bigint, switches bigint")


def language_spans(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, start, end, lang, n_words``: runs of words with one language within a chain, in bytes of the UTF-8 text, end exclusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        names = pa.array(model.langs, pa.string())
        for batch in batches:
            for row, base, data, offsets in labeller.parts(batch.column(1)) if model.langs else ():
                starts, ends, chain, found = labeller.label(data, offsets)
                if not len(starts):
                    continue
                best = found.argmax(axis=1)
                heads = np.flatnonzero(np.concatenate(([True], (best[1:] != best[:-1]) | (chain[1:] != chain[:-1]))))
                after = np.append(heads[1:], len(starts))
                of = np.searchsorted(offsets, starts[heads], "right") - 1
                shift = base - offsets[of]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row + of)),
                        pa.array(starts[heads] + shift),
                        pa.array(ends[after - 1] + shift),
                        names.take(pa.array(best[heads])),
                        pa.array(after - heads),
                    ],
                    ["doc_id", "start", "end", "lang", "n_words"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, start bigint, end bigint, lang string, n_words bigint")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(docs: DataFrame, rows: int, runs: int, run_words: int) -> list[tuple[str, list[str]]]:
    """Runs of words with their language, in a fixed order; at most ``runs`` a document and about ``rows`` documents a language."""
    known = docs.select("doc_id", "lang").where("doc_id IS NOT NULL AND lang IS NOT NULL").where(~held_out(F.col("doc_id")))
    counts = staged(known.groupBy("lang").agg(F.count("*").alias("n")), "langid-languages")
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 52)) / float(1 << 52)
    drawn = staged(known.join(counts, "lang").where(draw * F.col("n") < rows).select("doc_id", "lang").distinct(), "langid-drawn")
    chosen = docs.select("doc_id", "lang", "text").join(drawn, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = [w.lower() for w in WORD.findall(text or "") if any(map(str.isalpha, w))]
                step = max(run_words, (len(words) - run_words) / max(1, runs - 1))
                for k in range(runs):
                    part = words[int(k * step) : int(k * step) + run_words]
                    if part:
                        out.append((doc, lang, k, part))
            if out:
                columns = list(zip(*out))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "lang", "k", "words"])

    found = chosen.mapInArrow(cut, "doc_id bigint, lang string, k bigint, words array<string>").collect()  # bounded sample
    return [(r["lang"], r["words"]) for r in sorted(found, key=lambda r: (r["lang"], r["doc_id"], r["k"]))]


def fit(docs: DataFrame, rows: int = ROWS, runs: int = RUNS, run_words: int = RUN_WORDS) -> Model:
    """Learn from ``docs(doc_id, text, lang)``: rows with a language that are not held out."""
    return _train(_sample(docs, rows, runs, run_words))


def _train(sample: list[tuple[str, list[str]]]) -> Model:
    langs = sorted({lang for lang, _ in sample}, key=lambda x: x.encode())
    size = len(langs)
    if not size:
        return Model([], np.zeros((1, 0), np.float32), np.zeros((0, 0)), np.zeros(0), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    number = {lang: j for j, lang in enumerate(langs)}
    vocabulary: dict[str, int] = {}
    coded = [(number[lang], [vocabulary.setdefault(w, len(vocabulary)) for w in words]) for lang, words in sample]
    words = pa.array(list(vocabulary), pa.large_string())
    times = np.zeros((len(words), size))
    for lang, codes in coded:
        np.add.at(times[:, lang], codes, 1)
    features = Features()
    kinds, whole = features.of(words)
    total = times.sum(axis=1)
    sure = (total >= LEXICON_TIMES) & (times.max(axis=1) >= LEXICON_SHARE * total)
    order = np.argsort(whole[sure])
    model = Model(langs, np.zeros((BUCKETS + size + 1, size)), np.ones((size, size)), np.ones(size), whole[sure][order], times[sure].argmax(axis=1)[order])

    # Pairs of runs of any two documents: sequences that switch language, or do not.
    mixed = np.random.default_rng(13).permutation(len(coded))
    pairs = [(coded[a], coded[b]) for a, b in zip(mixed[::2], mixed[1::2])] or [(coded[0], coded[0])]
    length = max(len(a[1]) + len(b[1]) for a, b in pairs)
    codes, gold = np.full((len(pairs), length), -1), np.zeros((len(pairs), length), int)
    for i, (a, b) in enumerate(pairs):
        row, labels = a[1] + b[1], [a[0]] * len(a[1]) + [b[0]] * len(b[1])
        codes[i, : len(row)], gold[i, : len(row)] = row, labels
    here = codes >= 0
    truth = np.eye(size)[gold] * here[:, :, None]
    both = here[:, 1:] & here[:, :-1]
    pair_truth = np.zeros((size, size))
    np.add.at(pair_truth, (gold[:, :-1][both], gold[:, 1:][both]), 1)

    rows_of = np.concatenate([_lexicon_feature(model, whole), *(b for b, _ in kinds)])
    word_of = np.concatenate([np.arange(len(words)), *(np.repeat(np.arange(len(words)), np.diff(f)) for _, f in kinds)])
    order = np.argsort(word_of, kind="stable")
    rows_of, word_of = rows_of[order], word_of[order]
    bounds = np.searchsorted(word_of, np.arange(len(words)))
    weights, steps, first = model.weights, np.zeros((size, size)), np.zeros(size)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, steps, first)]
    for turn in range(1, ROUNDS + 1):
        emissions = np.add.reduceat(weights[rows_of], bounds, axis=0)
        found, pair_found = _expected(np.where(here[:, :, None], emissions[codes], 0.0), here, np.exp(steps), np.exp(first))
        missing = (truth - found)[here]
        per_word = np.column_stack([np.bincount(codes[here], missing[:, j], minlength=len(words)) for j in range(size)])
        slope = np.column_stack([np.bincount(rows_of, per_word[word_of, j], minlength=len(weights)) for j in range(size)])
        slopes = (slope, pair_truth - pair_found, (truth - found)[:, 0].sum(axis=0))
        for x, g, s in zip((weights, steps, first), slopes, state):
            g = g / len(pairs) - RIDGE * x / len(pairs)
            s[0] += 0.1 * (g - s[0])
            s[1] += 0.01 * (g * g - s[1])
            x += RATE * (s[0] / (1 - 0.9**turn)) / (np.sqrt(s[1] / (1 - 0.99**turn)) + 1e-8)
    return model._replace(weights=weights.astype(np.float32), steps=np.exp(steps - steps.max()), first=np.exp(first - first.max()))


def _expected(emissions: np.ndarray, here: np.ndarray, steps: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each place of padded sequences, and expected transitions, by forward-backward."""
    n, length, size = emissions.shape
    psi = np.exp(emissions - emissions.max(axis=2, keepdims=True))
    ahead = np.empty_like(psi)
    behind = np.ones_like(psi)
    v = first * psi[:, 0]
    for t in range(length):
        if t:
            v = np.where(here[:, t, None], (v @ steps) * psi[:, t], v)
        v = v / v.sum(axis=1, keepdims=True)
        ahead[:, t] = v
    for t in range(length - 2, -1, -1):
        back = (behind[:, t + 1] * psi[:, t + 1]) @ steps.T
        back = np.where(here[:, t + 1, None], back, behind[:, t + 1])
        behind[:, t] = back / back.sum(axis=1, keepdims=True)
    found = ahead * behind
    found /= found.sum(axis=2, keepdims=True)
    pairs = np.zeros((size, size))
    for t in range(1, length):
        joint = ahead[:, t - 1, :, None] * steps[None] * (psi[:, t] * behind[:, t])[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        pairs += joint[here[:, t]].sum(axis=0)
    return found * here[:, :, None], pairs
