"""The text operators against brute-force versions, and their defined results on odd rows."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from ctxlake.llm import chat, components, decontaminate, minhash, mixing, pii, spotsigs, substring, suffix, suffix_dedup, tokens, toxicity

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
# Columns whose names the operators use inside.
CLASH = "part int, grp int, key string, a int, b int, pack string, words string, hash int, n int, label int"


def frame(spark, rows, schema="doc_id bigint, text string, source string"):
    """Rows with extra columns of clashing names."""
    names = CLASH.count(",") + 1
    return spark.createDataFrame([(*r, *[None] * names) for r in rows], f"{schema}, {CLASH}")


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies, shared passages, benchmark passages and odd rows."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefgé", k=rng.randint(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, rows = text(60), []
    for i in range(60):
        kind = i % 6
        own = text(rng.randint(1, 120))
        if kind == 1:
            own = rows[rng.randrange(len(rows))][1]
        elif kind == 2:
            words = rows[rng.randrange(len(rows))][1].split()
            words[rng.randrange(len(words))] = "changed"
            own = " ".join(words)
        elif kind == 3:
            own = f"{own} {passage} {text(20)}"
        rows.append((i * 3, own, f"s{i % 4}"))
    rows += [(500, None, None), (501, "", "s0"), (502, "x", None), (503, " \n", "s1"), (504, "ab " * 3000, "s2")]
    rows += [rows[7], (None, rows[3][1], "s3"), (None, None, None)]
    return rows


def by_id(df, *columns):
    return Counter(tuple(r) for r in df.select("doc_id", *columns).collect())


# --- suffix arrays ---


@pytest.mark.parametrize("block,limit", [(1 << 18, 1 << 28), (3, 150)])
def test_suffix_order(monkeypatch, block, limit):
    monkeypatch.setattr(suffix, "BLOCK", block)
    rng = np.random.default_rng(1)
    for n, depth in itertools.product((1, 2, 17, 90), (3, 50)):
        data = rng.integers(0, 3, n).astype(np.uint8)
        data = np.concatenate((data, data[: n // 2]))
        body = data.tobytes()
        blocks = list(suffix.suffixes(data, depth, limit))
        positions = np.concatenate([p for p, _ in blocks]).tolist()
        common = np.concatenate([v for _, v in blocks]).tolist()
        assert sorted(positions) == list(range(len(body)))
        keys = [body[p : p + depth] for p in positions]
        assert keys == sorted(keys, reverse=True)
        for j in range(1, len(positions)):
            x, y = body[positions[j] :], body[positions[j - 1] :]
            same = next((k for k in range(min(len(x), len(y), depth)) if x[k] != y[k]), min(len(x), len(y), depth))
            assert common[j] == same


def test_suffix_dedup(spark, corpus):
    length, first = 50, {}
    for doc, text, _ in corpus:
        body = (text or "").encode()
        for p in range(len(body) - length + 1):
            if doc is not None:
                first[body[p : p + length]] = min(first.get(body[p : p + length], doc), doc)
    want = Counter()
    for doc, text, _ in corpus:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - length + 1):
            if doc is not None and first[body[p : p + length]] < doc:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, y in zip(body, gone) if not y)
        want[doc, len(body), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()] += 1
    found = suffix_dedup.repeated_bytes(frame(spark, corpus), length).selectExpr(
        "doc_id", "n_bytes", "n_removed", "CAST(size(starts) AS BIGINT) AS n_spans", "kept_sha256"
    )
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert any(k[2] for k in want)


def _removed(rows, length):
    """Brute force: document, bytes, removed bytes and digest of the rest, for each row."""
    first, want = {}, Counter()
    for doc, text, _ in rows:
        body = (text or "").encode()
        for p in range(len(body) - length + 1):
            if doc is not None:
                first[body[p : p + length]] = min(first.get(body[p : p + length], doc), doc)
    for doc, text, _ in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - length + 1):
            if doc is not None and first[body[p : p + length]] < doc:
                gone[p : p + length] = b"\1" * length
        want[doc, len(body), sum(gone), hashlib.sha256(bytes(x for x, y in zip(body, gone) if not y)).hexdigest()] += 1
    return want


def test_suffix_dedup_one_id_two_texts(spark, corpus):
    """Rows of one id with different texts: one a copy, one long, one short."""
    long, other = corpus[3][1] + corpus[9][1], corpus[15][1]
    rows = [*corpus, (700, corpus[0][1], "s"), (700, "own text " + "".join(map(str, range(90))), "s"), (701, long, "s"), (701, "short", "s"), (701, other, "s")]
    found = suffix_dedup.repeated_bytes(frame(spark, rows), 50)
    assert by_id(found, "n_bytes", "n_removed", "kept_sha256") == _removed(rows, 50)


def test_suffix_dedup_hot_passage(spark, corpus, monkeypatch):
    """A passage of every document travels once a group, in shards that spill."""
    sent, covered = [], suffix_dedup._covered
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 30_000)
    monkeypatch.setattr(suffix_dedup, "_covered", lambda snippets, *rest: sent.append(snippets) or covered(snippets, *rest))
    passage = corpus[4][1] + corpus[10][1]
    rows = [(i, f"{i * 7919} {passage} {i * 104729}", "s") for i in range(300)]
    found = suffix_dedup.repeated_bytes(frame(spark, rows), 50, limit=150)
    assert by_id(found, "n_bytes", "n_removed", "kept_sha256") == _removed(rows, 50)
    bytes_sent = sent[0].selectExpr("sum(octet_length(body))").first()[0]
    assert 2 * bytes_sent < sum(len(t.encode()) for _, t, _ in rows)  # one entry an occurrence would be more than all text


@pytest.mark.parametrize("length", (16, 17, 20, 50))
def test_suffix_dedup_sorts_what_shares_a_window(length):
    """A snippet left out of the sort shares no window with another; one alone is left out."""
    rng, windows, cut, left_out = np.random.default_rng(length), suffix_dedup.Windows(length), {}, 0
    common = rng.integers(97, 100, 60).astype(np.uint8)
    for k in range(60):
        own = rng.integers(97, 100, 40).astype(np.uint8)
        data = np.concatenate((own, common[k % 7 : 30 + k % 30], own[::-1]))
        _, least = windows.least(data, np.array([0, len(data)]))
        edge = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1], [True])))
        for a, b in zip(edge[:-1], edge[1:]):
            cut[data[a : b + length - 1].tobytes()] = None
    sizes = np.array([len(x) for x in cut])
    akin = suffix_dedup._akin(np.frombuffer(b"".join(cut), np.uint8), sizes, length)
    holders = Counter(w for x in cut for w in {x[i : i + length] for i in range(len(x) - length + 1)})
    for x, put in zip(cut, akin):
        assert put or all(holders[x[i : i + length]] == 1 for i in range(len(x) - length + 1))
        left_out += not put
    assert left_out > 0
    assert (left_out < len(cut)) == (length > windows.seed)  # snippets of one window each are all unlike


# --- substring ---


def test_substring(spark, corpus):
    size = 20
    split = [SPACE.findall(t or "") for _, t, _ in corpus]
    seen = Counter(tuple(w[p : p + size]) for w in split for p in range(len(w) - size + 1))
    want = Counter()
    for (doc, _, _), w in zip(corpus, split):
        gone = [0] * len(w)
        for p in range(len(w) - size + 1):
            if seen[tuple(w[p : p + size])] > 1:
                gone[p : p + size] = [1] * size
        kept = " ".join(x for x, y in zip(w, gone) if not y)
        want[doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert by_id(substring.repeated_words(frame(spark, corpus), size), "n_words", "n_removed", "kept_sha256") == want
    assert any(k[2] for k in want)


# --- near duplicates ---


def _sets(corpus, size):
    out = {}
    for doc, text, _ in corpus:
        w = SPACE.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))
        out[doc] = {tuple(w[p : p + size]) for p in range(max(1, len(w) - size + 1))} if w else set()
    return out


def test_near_duplicates(spark, corpus):
    sets = {d: s for d, s in _sets(corpus, 4).items() if d is not None}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    found = by_id(minhash.near_duplicates(frame(spark, corpus), 4, 80), "n_shingles", "component_id", "kept")
    want = Counter((d, len(sets[d]), root(d), root(d) == d) for d, _, _ in corpus if d is not None)
    assert Counter({k: v for k, v in found.items() if k[0] is not None}) == want
    assert [k[2:] for k in found if k[0] is None] == [(None, True)] * 2
    assert any(not k[3] for k in want)


@pytest.mark.parametrize("rounds,salt", [(1, 500), (0, 500), (1, 2)])
def test_near_duplicates_of_shared_ids(spark, monkeypatch, rounds, salt):
    """An id with several texts is one document: linked where one of its texts is, one component for all its rows."""
    rng = random.Random(11)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    near = lambda t: f"{t} {text(2)}"
    a, b, c, d, e, f = (text(60) for _ in range(6))
    rows = [(1, a), (5, a), (5, b), (9, b), (12, near(b)), (13, near(near(b))), (20, c), (20, d), (20, c), (21, near(d)), (22, near(c))]
    rows += [(30, e), (30, ""), (30, None), (29, near(e)), (40, ""), (41, None), (50, f), (51, f"{f} y"), (51, "")]
    rows += [(60, text(30)) for _ in range(9)]
    rows += [(61, near(rows[-1][1])), (62, near(rows[-4][1])), (63, text(30)), (62, text(30)), (64, near(rows[-1][1]))]
    rows = [(*r, "s") for r in rows]
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    monkeypatch.setattr(minhash, "SALT_ROWS", salt)
    got = Counter(map(tuple, minhash.near_duplicates(frame(spark, rows), 4, 80).select("doc_id", "n_shingles", "component_id").collect()))
    sets = [next(iter(_sets([r], 4).values())) for r in rows]
    parent = {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]):
            x, y = sorted((root(rows[i][0]), root(rows[j][0])))
            parent[y] = x
    assert got == Counter((r[0], len(s), root(r[0])) for r, s in zip(rows, sets))
    assert root(13) == 1 and root(22) == root(21) == 20 and root(30) == 29 and root(64) == 60


def test_links_past_the_compared_members(spark, monkeypatch):
    """Copies of a base that is not there: none is like the first, many are like each other."""
    rng = random.Random(3)
    base, rows = [f"w{i}" for i in range(120)], []
    for i in range(40):
        w = list(base)
        for p in rng.sample(range(120), 1 + i % 5):
            w[p] = f"x{i}.{p}"
        rows.append((i, " ".join(w), "s"))
    monkeypatch.setattr(minhash, "ROUNDS", 0)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows), 4, 80).collect()}
    monkeypatch.undo()
    assert got == {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows), 4, 80).collect()}
    sets = _sets(rows, 4)
    for a, b in itertools.combinations(range(40), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            assert got[a] == got[b]


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40), (40, 60), (7, 7), (1, 2)], "a bigint, b bigint")
    assert dict(components.components(edges).collect()) == {i: 0 for i in range(31)} | {40: 40, 50: 40, 60: 40}


# --- decontamination ---


def test_contamination(spark, corpus):
    word = re.compile(decontaminate.WORD)
    lower = lambda t: "".join(c.lower() if c < "\x80" else c for c in t or "")
    long = corpus[3][1].split()
    items = [(1, " ".join(long[:30])), (2, "x"), (3, " ".join(corpus[0][1].split()[:5])), (4, None), (5, "!!"), (10, " ".join(long[10:25]).upper()), (1, " ".join(long[:30]))]
    windows = {}
    for item, text in items:
        w = word.findall(lower(text))
        size = min(13, len(w))
        for p in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[p : p + size]), set()).add(item)
    want = Counter()
    for doc, text, _ in corpus:
        w = word.findall(lower(text))
        gone, hit = [0] * len(w), set()
        for size in {len(x) for x in windows}:
            for p in range(len(w) - size + 1):
                if doc is not None and tuple(w[p : p + size]) in windows:
                    gone[p : p + size] = [1] * size
                    hit |= windows[tuple(w[p : p + size])]
        n = sum(gone)
        digest = hashlib.sha256(",".join(sorted(map(str, hit))).encode()).hexdigest()
        want[doc, len(w), n, len(hit), digest, n > 0 and 20 * n >= len(w)] += 1
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id bigint, text string, at int")
    got = decontaminate.contamination(frame(spark, corpus), bench, 13, 20)
    assert by_id(got, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    assert any(k[5] for k in want)


# --- mixing ---


def test_mixing(spark, corpus):
    found = mixing.mix(frame(spark, corpus), budget_share=2.0, repeats=5.0, block_tokens=100).collect()
    assert len(found) == len(corpus)
    total = sum(len(SPACE.findall(t or "")) for _, t, _ in corpus)
    drawn, longest = Counter(), Counter()
    for r in found:
        drawn[r.source] += r.copies * r.n_tokens
        longest[r.source] = max(longest[r.source], r.n_tokens)
    for r in found:
        # A source gets its budget, at most one document more, and repeated rows.
        assert -1 <= drawn[r.source] - r.weight * 2 * total <= 2 * longest[r.source] + 1
        assert r.copies in (r.passes, r.passes + 1)


@pytest.mark.parametrize("share", [0.99, 0.9])
def test_mixing_entropy(spark, share):
    rows = [(i, "w " * 50, f"s{min(i, 3)}") for i in range(60)]
    weights = {r.source: r.weight for r in mixing.mix(frame(spark, rows), entropy=share).collect()}
    entropy = -sum(w * np.log(w) for w in weights.values())
    assert entropy == pytest.approx(share * np.log(4), abs=1e-6)


# --- token counts ---


@pytest.fixture(scope="module")
def ranks():
    pieces = [bytes([i]) for i in range(256)] + [b"ab", b"\n\n", b"\n\n\n", b" a", b" ab"]
    return {p: i for i, p in enumerate(pieces)}


@pytest.mark.parametrize("rule", tokens.RULES)
def test_section_tokens(spark, corpus, ranks, rule):
    rows = [*corpus, (900, "ab\n\n\nab ab\n", "s")]
    found = tokens.section_tokens(frame(spark, rows), ranks, rule).collect()
    encoder = tokens.Encoder(ranks)
    for doc, text, _ in rows:
        own = sorted((r.section, r.start, r.end, r.n_tokens) for r in found if r.doc_id == doc)
        if doc in (None, rows[7][0]):
            continue
        assert sum(r[3] for r in own) == pytest.approx(len(encoder.ends(text or "")))
        assert [b for _, _, b, _ in own] == np.cumsum([len(x.encode()) for x in re.findall(r"[^\n]*\n|[^\n]+", text or "")]).tolist()
    # Every byte of every token looked at on its own.
    for doc, text, _ in rows:
        if doc in (None, rows[7][0]) or not text:
            continue
        lines = re.findall(rb"[^\n]*\n|[^\n]+", text.encode())
        line_of = [k for k, line in enumerate(lines) for _ in line]
        want, start = [0.0] * len(lines), 0
        for end in encoder.ends(text):
            over = Counter(line_of[start:end])
            if rule == "split":
                for k, n in over.items():
                    want[k] += n / (end - start)
            else:
                want[{"first": line_of[start], "last": line_of[end - 1], "most": max(over, key=lambda k: (over[k], -k))}[rule]] += 1
            start = end
        got = {r.section: r.n_tokens for r in found if r.doc_id == doc}
        assert [got[k] for k in range(len(lines))] == pytest.approx(want)


def test_field_tokens(spark, ranks):
    df = spark.createDataFrame([(1, "ab", None, "ab ab"), (2, None, None, None)], "id bigint, x string, y string, z string")
    found = Counter()
    for r in tokens.field_tokens(df, "id", ["x", "y", "z"], ranks).collect():
        found[r.id] += r.n_tokens
        assert r.doc_tokens == len(tokens.Encoder(ranks).ends("ab\n\nab ab" if r.id == 1 else "\n\n"))
    assert found[1] == len(tokens.Encoder(ranks).ends("ab\n\nab ab"))


# --- fingerprints ---


def test_spotsigs(spark, corpus):
    rows = list(dict((r[0], r) for r in corpus if r[0] is not None).values())
    got = {r.doc_id: r for r in spotsigs.edited_likeness(frame(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for k, (doc, text, _) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut] if cut else text
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[doc].near_next <= 1
        for other, t, _ in rows:
            if (t or "") == text:
                assert got[other].fingerprint == got[doc].fingerprint
    assert spotsigs.edited_likeness(frame(spark, corpus)).count() == len(corpus)


def _spots(text):
    """Chains and trigrams of a text as plain tuples, by the rule of the module."""
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in text))
    content = [k for k, w in enumerate(words) if w not in spotsigs.ANCHORS]
    out, last = Counter(), -spotsigs.GAP - 1
    for k, w in enumerate(words):
        if w in spotsigs.ANCHORS:
            last = k
        if k == last or k - last > spotsigs.GAP:
            chain = [words[c] for c in content if c > k][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                out[(w, *chain)] += 1
    return {(c, n) for c, many in out.items() for n in range(many)}


def test_spotsigs_chains(spark):
    """Fingerprints differ as sets of chains do; trigrams are the least hashes of all of them, so their share is told apart."""
    rng = random.Random(8)
    pool = [*spotsigs.ANCHORS[:12], *(f"c{i}" for i in range(60)), "é1", "Ω"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(1, 200))) + rng.choice(["", ". ", " -- x"]) for _ in range(60)]
    spots = spotsigs.Spots()
    for text in texts:
        chains = _spots(text)
        grams = {text.encode()[i : i + 3].ljust(3, b"\0") for i in range(len(text.encode()))}
        assert len(spots.of(text.encode())) == len(chains) + min(len(grams), spotsigs.LEAST)
    for x, y in itertools.combinations(texts[:25], 2):
        a, b, p, q = spots.of(x.encode()), spots.of(y.encode()), _spots(x), _spots(y)
        shared = len(p & q)
        assert shared <= len(np.intersect1d(a, b)) <= shared + spotsigs.LEAST
        both = len(np.intersect1d(a, b))
        assert spotsigs.likeness(a, b) == both / (len(a) + len(b) - both)


def test_spotsigs_short_texts(spark):
    """No length at which one more word makes another text."""
    words, spots = [f"word{i}" for i in range(30)], spotsigs.Spots()
    near = [spotsigs.likeness(spots.of(" ".join(words[:n]).encode()), spots.of(" ".join(words[: n + 1]).encode())) for n in range(4, 29)]
    assert min(near) > 0.4


def test_spotsigs_likeness_of_rows(spark, corpus):
    rows = list(dict((r[0], r) for r in corpus if r[0] is not None).values())
    got = {r.doc_id: r for r in spotsigs.edited_likeness(frame(spark, rows)).collect()}
    spots, order = spotsigs.Spots(), sorted(rows, key=lambda r: -r[0])
    for k, (doc, text, _) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        own, edited, other = (spots.of(t.encode()) for t in (text, text[: len(text) - cut] + after[:cut], after))
        assert got[doc].fingerprint == own.astype(">u4").tobytes().hex()
        assert got[doc].edited_fingerprint == edited.astype(">u4").tobytes().hex()
        assert (got[doc].near_edited, got[doc].near_next) == (spotsigs.likeness(own, edited), spotsigs.likeness(own, other))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 200])
def test_bounds_by_halving(spark, n):
    bounds = sorted(random.Random(n).sample(range(-500, 500), n))
    frame_ = spark.range(-510, 510).select("id", spotsigs._at_most(bounds, "id").alias("k"))
    assert all(r.k == sum(b <= r.id for b in bounds) for r in frame_.collect())


def test_spotsigs_ranges(spark, corpus, monkeypatch):
    """Ranges of ids give what one range gives."""
    whole = by_id(spotsigs.edited_likeness(frame(spark, corpus)), "edited_sha256", "near_next")
    monkeypatch.setattr(spotsigs, "ROWS_A_BUCKET", 7)
    assert by_id(spotsigs.edited_likeness(frame(spark, corpus)), "edited_sha256", "near_next") == whole


def test_spotsigs_join(spark, corpus):
    sets = {d: frozenset(spotsigs.Spots().of((t or "").encode()).tolist()) for d, t, _ in corpus if d is not None}
    classes, pairs = spotsigs.similar(frame(spark, corpus), 0.5)
    heads = dict(classes.collect())
    found = {(min(p), max(p)) for p in ((r.a, r.b) for r in pairs.collect())}
    want = set()
    for a, b in itertools.combinations(sorted(set(heads.values())), 2):
        if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.5:
            want.add((a, b))
    assert found == want
    assert all(sets[d] == sets[h] for d, h in heads.items()) and set(heads) == {d for d, s in sets.items() if s}


# --- toxicity ---


def test_toxicity(spark):
    rng = random.Random(2)
    words = ["calm", "river", "stone", "light", "paper", "garden", "window"]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, " ".join(rng.choices(words, k=30) + (["grubbish" + rng.choice(["ly", "er", ""])] if bad else [])), "s"))
        labels.append((i, 1, int(bad)))
    rows += [(1000, "GRUBBI5HLY river", "s"), (1001, "grubbіsh stone", "s"), (1002, None, "s"), (1003, "", "s"), (None, "calm", "s"), (1004, "clown fish", "s")]
    docs = frame(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame([*labels, (5, 1, None), (None, 0, 1)], "doc_id bigint, quality int, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.3) == (i % 4 == 0) for i in range(400))
    assert got[1000] >= 0.3 and got[1001] >= 0.3
    assert max(got[d] for d in (1002, 1003, None, 1004)) < 0.3
    empty = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert empty.curve == toxicity.CURVE


def test_matching_equals_plain_search():
    """Weights of matched words, and phrases that spare them, against looking at every place of the folded text."""
    rng = random.Random(6)
    lexicon = {" ab": 2.0, " abc": 3.0, " abc ": 5.0, " ca": 1.0, " b ": 4.0}
    phrases = ("ab ca", "b abc ca", "ca")
    matcher = toxicity.Matcher(lexicon, phrases)
    for _ in range(300):
        text = " ".join("".join(rng.choices("abc@48", k=rng.randint(1, 4))) for _ in range(rng.randint(0, 30)))
        plain = toxicity.folded(text)
        spared = [(a, a + len(toxicity.folded(p)) - 1) for p in phrases for a in range(len(plain)) if plain.startswith(toxicity.folded(p), a)]
        want = []
        for at in range(len(plain)):
            found = [w for pattern, w in lexicon.items() if plain.startswith(pattern, at)]
            if found and not any(a <= at < b for a, b in spared):
                want.append(max(found))
        got, words = matcher.hits(text)
        assert sorted(got) == sorted(want) and words == len(plain.split())


def test_long_words_and_many_phrases(spark):
    """A long word is learned whole; many phrases and many matches in one text take time that grows with its length."""
    word = "x" * 30 + "y" * 30
    assert f" {word} " in toxicity._features(f"a {word} b", toxicity._Fold())
    matcher, start = toxicity.Matcher({" clown": 1.0}, ("clown fish",)), time.time()
    assert len(matcher.hits("clown fish clown " * 60_000)[0]) == 60_000
    assert time.time() - start < 5


# --- personal data ---


def _base(text):
    """Base spans by the letter of the contract: leftmost matches of each pattern, failing ones dropped."""
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.compile(pattern).finditer(text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            twice = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and sum(twice) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans(spark):
    rng = random.Random(9)
    pieces = ["a.b@c.de", "x@y", "@", "10.0.0.255", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (743) 555-3824", "+", "12", " ", ".", "-", "007.1.1.1", "é", "+49", "55555", "4111111111111111"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(3000)]
    for text in texts:
        assert pii.spans(text)[0] == _base(text)
    found = {r.doc_id: r.base for r in pii.find(frame(spark, [(i, t, "s") for i, t in enumerate(texts[:300])])).collect()}
    assert all([tuple(x) for x in found[i]] == _base(t) for i, t in enumerate(texts[:300]))


def test_many_addresses_in_one_text():
    text, start = "a.b@c.de bob [at] site [dot] org " * 20_000, time.time()
    base, every = pii.spans(text)
    assert len(base) == 20_000 and len(every) == 40_000
    assert time.time() - start < 20


@pytest.mark.parametrize(
    "text,found",
    [
        ("write to anna.b at example dot org now", ["anna.b at example dot org"]),
        ("bob[at]site(dot)co[dot]uk", ["bob[at]site(dot)co[dot]uk"]),
        ("jоhn@exаmple.com", ["jоhn@exаmple.com"]),
        ("call plus one five five five one two three four five", ["plus one five five five one two three four five"]),
        ("host 192 dot 168 dot 1 dot 20", ["192 dot 168 dot 1 dot 20"]),
        ("wide ４１１１１１１１１１１１１１１１", ["４１１１１１１１１１１１１１１１"]),
        ("meet at noon, they are at the dot com bubble", []),
        ("999.1.1.1 and 4111 1111 1111 1112 and +1 2", []),
        ("a@b.c 10.0.0.255, 4111-1111-1111-1111, +1 (743) 555-3824", ["a@b.c", "10.0.0.255", "4111-1111-1111-1111", "+1 (743) 555-3824"]),
    ],
)
def test_pii(text, found):
    assert [text[a:b] for _, a, b in pii.spans(text)[1]] == found


@pytest.mark.parametrize(
    "text,found",
    [
        ("call plus 44 20 7946 0958 now", ["plus 44 20 7946 0958"]),
        ("call plus four nine 30 1234567", ["plus four nine 30 1234567"]),
        ("host one nine two dot one six eight dot zero dot one", ["one nine two dot one six eight dot zero dot one"]),
        ("host 10 dot 0 dot 0 dot seven, plus four nine 30 1234567", ["10 dot 0 dot 0 dot seven", "plus four nine 30 1234567"]),
        ("card 4111111111111 one one one", ["4111111111111 one one one"]),
        ("mail jane.seven-two at example dot com", ["jane.seven-two at example dot com"]),
        ("bob    at    site    dot    org", ["bob    at    site    dot    org"]),
        ("bob      [  at    ]     site      (dot)      org", ["bob      [  at    ]     site      (dot)      org"]),
        ("plus     four      nine 30     1234567", ["plus     four      nine 30     1234567"]),
        ("one two plus three, three nine nine dot one dot one dot one", []),
    ],
)
def test_pii_mixed(text, found):
    assert [text[a:b] for _, a, b in pii.spans(text)[1]] == found


def test_pii_frames(spark, corpus):
    rows = [*corpus, (700, "mail a@b.co and x (at) y.org", "s")]
    found = {r.doc_id: r for r in pii.find(frame(spark, rows)).collect()}
    assert len(found[700].base) == 1 and len(found[700].spans) == 2
    assert found[500].spans == [] and found[501].spans == []
    red = pii.redact(frame(spark, rows))
    assert red.columns == frame(spark, rows).columns
    texts = {r.doc_id: r.text for r in red.collect()}
    assert texts[700] == "mail <EMAIL> and <EMAIL>" and texts[500] is None and texts[501] == ""


# --- chat ---


def _cheapest(roles):
    """Least cost by trying all ways."""
    best = {chat.START: 0}
    for given in roles:
        after = {}
        for state, cost in best.items():
            for role in range(3):
                label = chat._label_cost(given, role)
                if state == role:
                    after[role] = min(after.get(role, 10**9), cost + chat.COST_MERGE + label)
                way = chat.FILL[state, role]
                if way is not None:
                    after[role] = min(after.get(role, 10**9), cost + len(way) * chat.COST_INSERT + label)
        best = after
    return min(c + len(chat.CLOSE[s]) * chat.COST_INSERT for s, c in best.items())


@pytest.mark.parametrize("rows_a_part", [20_000, 3])
def test_chat_repair(spark, monkeypatch, rows_a_part):
    monkeypatch.setattr(chat, "ROWS_A_PART", rows_a_part)
    rng = random.Random(4)
    names = ["system", "user", "assistant", "Human", None, "tool"]
    rows = [(c, t, rng.choice(names), rng.choice(["hi", None, ""])) for c in range(12) for t in range(rng.randint(1, 9))]
    rows += [(None, 0, "user", "x"), (None, None, "user", "y"), (99, 1, "user", "z"), (99, 1, "user", "z")]
    turns = frame(spark, rows, "conv_id bigint, turn bigint, role string, text string")
    found = sorted(chat.repair(turns).collect(), key=lambda r: (r.part, r.place))
    assert len(found) == len(rows)
    for conv in {r[0] for r in rows}:
        own = [r for r in found if r.conv_id == conv]
        cost, given = 0, []
        for r in own:
            code = chat.role_code(r.role)
            given.append(code)
            cost += chat._label_cost(code, chat.ROLES.index(r.fixed_role)) + (chat.COST_MERGE if r.action == "merge" else 0)
            cost += chat.COST_INSERT * len(r.inserted.split(",")) if r.inserted else 0
        cost += chat.COST_INSERT * len(chat.CLOSE[chat.ROLES.index(own[-1].fixed_role)])
        assert cost == _cheapest(given)
        heads = re.findall(r"<\|(system|user|assistant)\|>", "".join(r.piece for r in own))
        body = heads[1:] if heads[0] == "system" else heads
        assert body == ["user", "assistant"] * (len(body) // 2) and body
        assert "".join(r.piece for r in own).count("<|end|>") == len(heads)


# --- empty tables ---


def test_empty_tables(spark):
    docs = frame(spark, [])
    bench = spark.createDataFrame([], "item_id bigint, text string")
    for found in (
        suffix_dedup.repeated_bytes(docs), substring.repeated_words(docs), minhash.near_duplicates(docs), decontaminate.contamination(docs, bench),
        mixing.mix(docs, repeats=4.0), spotsigs.edited_likeness(docs), pii.find(docs), pii.redact(docs),
        toxicity.score(docs, toxicity.Model({}, (), toxicity.CURVE)), tokens.section_tokens(docs, {bytes([i]): i for i in range(256)}),
        chat.repair(frame(spark, [], "conv_id bigint, turn bigint, role string, text string")), *spotsigs.similar(docs),
    ):
        assert found.count() == 0
    assert not decontaminate.contamination(frame(spark, [(1, "a b", "s")]), bench).first().contaminated
