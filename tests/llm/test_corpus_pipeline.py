"""The whole pipeline against brute force on a small fixture."""

import hashlib
import random

import corpus_pipeline
from ctxlake.llm import mixing


def _md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def _drawn(rows, budget_share):
    """Brute force for equal weights and one block a source: (doc_id, pass, block order, place) of each draw."""
    budget, want = budget_share * sum(n for _, _, n in rows), []
    sources = sorted({s for _, s, _ in rows})
    for source in sources:
        own = sorted((r for r in rows if r[1] == source), key=lambda r: _md5("mix", r[0]))
        tokens = sum(n for *_, n in own)
        passes = int(budget / len(sources) // tokens)
        rest, reached, place = int(budget / len(sources) - passes * tokens), 0, 0
        for doc, _, n in own:
            copies = passes + (reached < rest)
            reached += n
            place += copies > 0
            want += [(doc, k, _md5("mix", source, k, 0), place) for k in range(1, copies + 1)]
    return sorted(want)


def test_pipeline(spark, tmp_path):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefg", k=6)) for _ in range(300)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, text(40) + (" grubbish" if bad else ""), "small" if i % 10 == 1 else "big"))
        labels.append((i, 1, int(bad)))
    kept = [r for r in rows if r[0] % 4]
    rows += [(500, kept[0][1], "big"), (501, kept[1][1] + " more", "small")]  # a copy and a near copy
    item = text(20)
    rows += [(502, f"{text(5)} {item} {text(5)}", "small")]  # contaminated
    last = (503, f"{text(5)} x (at) y.org {text(5)}", "small")  # personal data: three words become one
    rows += [last]
    kept.append((503, "w " * 11, "small"))
    for name, data, schema in [
        ("documents", [(*r, len(r[1])) for r in rows], "doc_id bigint, text string, source string, n_chars bigint"),
        ("labels", labels, "doc_id bigint, quality int, toxic int"),
        ("benchmark", [(1, item)], "item_id bigint, text string"),
    ]:
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = _drawn([(d, s, len(t.split())) for d, t, s in kept], corpus_pipeline.BUDGET)
    assert sorted((r.doc_id, r["pass"], r.block_order, r.place) for r in found) == want
    assert {r.doc_id for r in found} < {d for d, *_ in kept} and max(r["pass"] for r in found) > 1


def test_near_duplicate_stage_on_odd_rows(spark):
    """Unlike texts of one id stay together, repeated rows become one, odd rows stay, any column type goes through."""
    rng = random.Random(5)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    a, b, c, d = (text() for _ in range(4))
    rows = [(1, a), (2, b), (2, c), (2, c), (3, c + " more"), (4, d), (4, d), (5, None), (6, ""), (7, ""), (None, a), (None, None)]
    docs = spark.createDataFrame(
        [(*r, "s", {"k": i % 2}) for i, r in enumerate(rows)], "doc_id bigint, text string, source string, extra map<string,int>"
    )
    found = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert found.columns == docs.columns
    want = [(1, a), (2, b), (2, c), (4, d), (5, None), (6, ""), (7, ""), (None, a), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == sorted(want, key=str)
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").isEmpty()


def test_draws_fill_the_budget(spark):
    """Positions are unique, and in their order the part pass ends where the plan says."""
    rows = [(i, "w " * (1 + i % 5), f"s{i % 7 == 0}") for i in range(200)] + [(900, None, None)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), repeats=4.0, block_tokens=20)
    drawn = mixing.draws(found).collect()
    assert len(drawn) == sum(r.copies for r in found.collect())
    spots = [(r.source, r["pass"], r.block_order, r.place) for r in drawn]
    assert len(set(spots)) == len(spots)
