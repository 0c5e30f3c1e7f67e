"""Collocations, the Merkle manifest and language identification against brute-force versions, and their results on odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ctxlake.llm import collocations, langid, manifest_tree

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns whose names the operators use inside.
CLASH = "grp int, rank int, block int, hash string, kids int, n int, f int, length int, w1 string, phrase string, score int, salt int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (CLASH.count(",") + 1)) for r in rows], f"{SCHEMA}, {CLASH}")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = [f"{c}{k}" for c in "aBé" for k in range(5)]
    out = []
    for i in range(130):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "! "]) for _ in range(rng.randint(0, 40)))
        out.append((i * 7 % 131, text, rng.choice(["en", "en", "de", None]), rng.choice(["s", "s", "t"]), len(text)))
    out += [(500, None, "en", "one", None), (501, "", None, None, 0), (502, "x\ny", "und", None, 3), (None, "a\nb", "de", "s", 3)]
    return out + [out[5], (out[6][0], "other\ntext", "en", out[6][3], 10)] + [(None, "a\nb", "de", "s", 3)] * 2


# --- collocations ---


def plain_collocations(rows, most, least, best, share):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, most + 1):
                f.update((lang or "und", tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    out = {}
    frequent = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    longer = Counter()
    for (lang, words), a in frequent.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                longer[lang, words[i : i + size]] = max(longer[lang, words[i : i + size]], a)
    for (lang, words), a in frequent.items():
        if 100 * longer[lang, words] >= share * a:
            continue
        cuts = [(2000000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]], k))
    return {
        (lang, rank, p.decode(), -a, left, right, n[lang], -s, k)
        for lang, found in out.items()
        for rank, (s, a, p, left, right, k) in enumerate(sorted(found)[:best], 1)
    }


@pytest.mark.parametrize("bits,chunk", [(24, 1 << 21), (3, 97)])
def test_collocations(spark, rows, monkeypatch, bits, chunk):
    """Also with a nearly full bitmap, and with texts cut into chunks of a few words."""
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    rows = rows + [(900, "a1 a2 B3 a1 " * 200 + "w" * 300 + " a1 a2", "en", "s", 0), (901, "Z", "en", "s", 1)]
    found = collocations.collocations(frame(spark, rows), least=4, best=25, share=80, gram_bits=bits)
    got = found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut").collect()
    assert {tuple(r) for r in got} == plain_collocations(rows, 4, 4, 25, 80)
    assert len(got) == len(set(got)) > 30


def test_collocations_odd_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(empty).count() == 0
    only_nulls = frame(spark, [(1, None, None, None, None), (2, " ,. ", "en", "s", 4)])
    assert collocations.collocations(only_nulls).count() == 0
    ties = frame(spark, [(1, "b a. d c. b a. d c.", None, "s", 1)])
    assert [(r.lang, r["rank"], r.phrase, r.score) for r in collocations.collocations(ties, least=2).orderBy("rank").collect()] == [("und", 1, "b a", 1000000), ("und", 2, "d c", 1000000)]


@pytest.mark.parametrize("chunk", [1 << 19, 11])
def test_window_counts_of_one_long_piece(monkeypatch, chunk):
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    text = "x yy x é zzz " * 50
    batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array(["en"])], ["text", "lang"])
    got = Counter()
    for found in collocations._windows(3, [], 24)([batch]):
        for lang, *key, c in zip(*(column.to_pylist() for column in found.columns)):
            got[tuple(key)] += c
    words = [*text.split(), "", ""]
    assert got == Counter(zip(words, words[1:], words[2:]))


@pytest.mark.parametrize("size", [1, 20, 100000])
def test_packs_of_hashes_are_small_and_counted_exactly(size):
    rng, least = np.random.default_rng(4), 300
    low = collocations.HASH_BITS - collocations.RANGE_BITS
    tasks = [np.concatenate((rng.integers(0, 1 << collocations.HASH_BITS, size), rng.integers(0, 9, 8 * least), [(1 << collocations.HASH_BITS) - 1] * 200)).astype(np.uint64) for _ in range(3)]
    sent = [pack for hashes in tasks for pack in collocations._packs(hashes, least)]
    got = set()
    for part in {p[0] for p in sent}:
        group = pa.table({"pack": [p[1] for p in sent if p[0] == part], "counts": [p[2] for p in sent if p[0] == part]})
        found = collocations._frequent(least)((pa.scalar(2), pa.scalar(part)), group)
        got |= set(found["gram"].to_pylist())
        assert all(g >> low == part for g in found["gram"].to_pylist())
    counts = Counter(h for hashes in tasks for h in hashes.tolist())
    assert got == {h for h, c in counts.items() if c >= least} and len(got) >= 9
    assert sum(len(p[1]) for p in sent) == 3 * sum(len(np.unique(hashes)) for hashes in tasks)


def test_words_of_no_frequent_pair_lead_no_windows(spark):
    """They only add to the total of their language: a row for each language instead of a row for each word."""
    text = "a b " * 40 + " ".join(f"r{k} often{k % 50}" for k in range(5000))
    frame = spark.createDataFrame([(1, text)], "doc_id int, text string")
    bitmaps, bits = collocations.frequent_grams(frame, [2], 30, {})
    bitmaps |= collocations.frequent_grams(frame, [1, 3], 30, bitmaps, bits)[0]
    assert bits == 15 and {k: len(b) for k, b in bitmaps.items()} == {1: 1 << 12, 2: 1 << 12, 3: 1 << 12}
    rows = list(collocations._windows(4, bitmaps, bits)([pa.RecordBatch.from_arrays([pa.array([text, "r1 r2"]), pa.array(["en", "de"])], ["text", "lang"])]))
    got = {tuple(key): c for batch in rows for *key, c in zip(*(column.to_pylist() for column in batch.columns))}
    assert sum(got.values()) == 10082 and got["de", "", "", "", ""] == 2
    assert len(got) < 12


# --- manifest ---


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return digest(*parts)


def plain_tree(leaves):
    """Root, and for each leaf its runs from the bottom up as (run, place in it)."""
    runs, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, place in enumerate(at):
            start = place // 3 * 3
            runs[i].append((level[start : start + 3], place - start))
            at[i] = place // 3
        level = [digest(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], runs


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        trees[name] = ordered, *plain_tree([plain_leaf(*r) for r in ordered])
    root, upper = plain_tree([trees[name][1] for name in names])
    for name, above in zip(names, upper):
        ordered, subroot, runs = trees[name]
        for row, own in zip(ordered, runs):
            proof = "".join(h for run, place in own + above for k, h in enumerate(run) if k != place)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            got = plain_leaf(row[0], row[1].replace("\n", "") if tampered and row[1] is not None else row[1], *row[2:])
            for run, place in own + above:
                got = digest(*run[:place], got, *run[place + 1 :])
            yield row[0], plain_leaf(*row), subroot, root, digest(proof), got, got == root


@pytest.mark.parametrize("depth", [6, 2])
def test_manifest(spark, rows, monkeypatch, depth):
    """With one tier, and with blocks of nine leaves in several tiers."""
    monkeypatch.setattr(manifest_tree, "DEPTH", depth)
    found = manifest_tree.manifest(frame(spark, rows), *manifest_tree.tampering())
    got = found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    expected = Counter(plain_manifest(rows))
    assert Counter(map(tuple, got)) == expected
    assert {r[-1] for r in expected} == {True, False}


def test_manifest_of_few_rows(spark):
    assert manifest_tree.manifest(spark.createDataFrame([], SCHEMA), *manifest_tree.tampering()).count() == 0
    long = "line\n" * 300_000
    for rows in ([(1, "a", "en", "s", 1)], [(1, None, None, None, None)], [(2, long, "en", "s", len(long)), (3, "", "en", "t", 0)]):
        found = manifest_tree.manifest(frame(spark, rows), *manifest_tree.tampering())
        got = found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
        assert Counter(map(tuple, got)) == Counter(plain_manifest(rows))


# --- language ---


def test_posteriors():
    """Against the sum over all labellings, with chains inside and over block edges."""
    rng = np.random.default_rng(2)
    langid_block = langid.BLOCK
    try:
        langid.BLOCK = 3
        for n in (1, 3, 7, 8):
            emissions, steps, first = rng.normal(size=(n, 2)), rng.random((2, 2)), rng.random(2)
            opens = rng.random(n) < 0.3
            opens[0] = True
            total, expected = 0, np.zeros((n, 2))
            for labels in itertools.product(range(2), repeat=n):
                p = 1.0
                for i, y in enumerate(labels):
                    p *= np.exp(emissions[i, y]) * (first[y] if opens[i] else steps[labels[i - 1], y])
                total += p
                for i, y in enumerate(labels):
                    expected[i, y] += p
            assert np.allclose(langid.posteriors(emissions, opens, steps, first), expected / total)
            if not opens[1:].any():
                found, pairs = langid._expected(emissions[None], np.ones((1, n), bool), steps, first)
                assert np.allclose(found[0], expected / total) and np.isclose(pairs.sum(), n - 1)
    finally:
        langid.BLOCK = langid_block


SPOKEN = {"en": "the of and house river walking thing with that", "de": "der die und haus fluß gehend ding mit daß", "fr": "le la et maison rivière marchant chose avec que"}


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(8)
    text = lambda lang, n: " ".join(rng.choice(SPOKEN[lang].split()) for _ in range(n)).capitalize() + "."
    return [(i, text(lang, rng.randint(1, 30)), lang, "s", 0) for i in range(240) for lang in [rng.choice(["en", "en", "de", "fr"])]], text


def test_language(spark, spoken, monkeypatch):
    rows, text = spoken
    odd = [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "12 — 34!", None, "s", 0), (None, "le la maison", "de", "s", 0), rows[4], rows[4]]
    odd += [(903, text("en", 9)[:-1] + " " + text("fr", 9), None, "s", 0), (904, (text("de", 40) + " ") * 60, None, "s", 0), (905, "ß" * 700, None, "s", 0)]
    docs = frame(spark, rows + odd)
    model = langid.fit(docs, rows=40)
    assert model.langs == ["de", "en", "fr"]
    found = langid.identify(docs, model).collect()
    assert len(found) == len(rows + odd) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[r[0]].lang_pred == r[2] for r in rows)
    assert [by_id[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by_id[900].score == by_id[902].score == 0
    assert by_id[None].lang_pred == "fr" and by_id[904].lang_pred == "de" and by_id[903].switches == 1
    spans = langid.language_spans(docs.where("doc_id = 903"), model).orderBy("start").collect()
    body = odd[6][1].encode()
    assert [r.lang for r in spans] == ["en", "fr"] and sum(r.n_words for r in spans) == 18
    assert body[spans[0].start : spans[-1].end] == body[:-1]
    # Long texts in many chunks: the same words, cut at the same places whatever the batch.
    monkeypatch.setattr(langid, "CHUNK_BYTES", 200)
    cut = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert all(cut[i].lang_pred == r.lang_pred and cut[i].n_words == r.n_words for i, r in by_id.items())


def test_language_without_labels(spark):
    docs = frame(spark, [(1, "some text", None, "s", 9), (2, None, None, "s", 0)])
    assert {(r.lang_pred, r.score) for r in langid.identify(docs, langid.fit(docs)).collect()} == {("und", 0.0)}
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.identify(empty, langid.fit(empty)).count() == 0
    one = frame(spark, [(i, "un mot", "fr", "s", 6) for i in range(9)])
    assert {r.lang_pred for r in langid.identify(one, langid.fit(one)).collect()} == {"fr"}


def test_held_out_rows_are_not_learned_from(spark, spoken):
    rows, _ = spoken
    docs = frame(spark, rows)
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    a, b = langid.fit(docs, rows=40), langid.fit(other, rows=40)
    assert a.langs == b.langs and np.array_equal(a.weights, b.weights)
