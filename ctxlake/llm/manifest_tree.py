"""Merkle manifest of a dataset by a rollup of nested structs.

Every row is a leaf, ranked within its group (a source). The base-3 digits of a rank are columns; grouping them away one after
another nests the children of a node in its struct, with their digests concatenated and hashed on the way. Ranks are cut
into blocks of ``3 ** DEPTH``, so a struct holds at most that many leaves however large its group is; the blocks of a group are
the leaves of the next tier, and the groups' own roots are the leaves of one last tree. Within a block proofs come out of the nested structs
by ``transform`` and ``explode`` alone. Between tiers the row of a block meets the row with its own proof once, one to one: one struct
for a whole group would not be bounded.

A digest is the lowercase hex sha256 of its inputs, concatenated. Rows with equal doc_id are ordered by their digest; equal
rows are leaves of their own with equal digests, so their order does not matter. A null doc_id comes first, a null source is a group of
its own and the first. Null, empty and very long texts are values like others; a text lies in memory once while it is hashed and is
not shuffled. Extra columns take no part. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import staged

DEPTH = 6
ARITY = 3
PARTS = ("doc_id", "source", "lang", "n_chars", "text")


def item(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(**columns: Column) -> Column:
    return F.sha2(F.concat(*(item(columns[name]) for name in PARTS)), 256)


def leaves(docs: DataFrame, tampered: Column, text: Column) -> DataFrame:
    """``grp, doc_id, hash, seen``: each row's group key and digest, and the digest of ``text`` in place of its own where ``tampered``."""
    own = {name: F.col(name) for name in PARTS}
    grp = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    seen = F.when(tampered, leaf(**(own | {"text": text})))
    return docs.select(grp.alias("grp"), "doc_id", leaf(**own).alias("hash"), seen.alias("seen"))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows(grp, ...)`` with ``rank`` (from 0) and ``n`` within ``grp``.

    Rows are dealt by ranges of (grp, order), counted a range, and numbered within it; ``order`` must tell rows apart, so that
    no range outgrows a task.
    """
    dealt = staged(rows.repartitionByRange("grp", *order).withColumn("part", F.spark_partition_id()), "manifest-dealt")
    counts = dealt.groupBy("grp", "part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("grp").orderBy("part")) - F.col("size")
    starts = counts.select("grp", "part", before.alias("start"), F.sum("size").over(Window.partitionBy("grp")).alias("n"))
    starts = staged(starts, "manifest-starts")
    place = F.row_number().over(Window.partitionBy("grp", "part").orderBy(*order))
    return dealt.join(starts, ["grp", "part"]).withColumn("rank", F.col("start") + place - 1).drop("part", "start")


def _height(n: str) -> str:
    """Levels above the leaves of a group of ``n``."""
    return " + ".join(f"CAST({n} > {ARITY**k} AS INT)" for k in range(40))


def _tier(nodes: DataFrame, tier: int, payload: list[str]) -> DataFrame:
    """``nodes(grp, height, rank, hash, payload...)`` to one row a block: ``grp, height, block, hash, kids``.

    All groupings run in the tasks of one exchange: its keys are part of the keys of each.
    """
    digits = [f"d{k}" for k in range(DEPTH)]
    numbered = nodes.withColumns(
        {"block": F.expr(f"rank div {ARITY**DEPTH}")} | {d: F.expr(f"CAST(rank div {ARITY**k} % {ARITY} AS INT)") for k, d in enumerate(digits)}
    )
    df = numbered.repartition("grp", "block").withColumn("node", F.struct(F.col("d0").alias("digit"), "hash", *payload))
    for k in range(DEPTH):
        df = df.groupBy("grp", "height", "block", *digits[k + 1 :]).agg(F.sort_array(F.collect_list("node")).alias("kids"))
        # Above a group's root nothing is hashed any more: the only child stands for itself.
        up = F.sha2(F.array_join(F.expr("transform(kids, k -> k.hash)"), ""), 256)
        df = df.withColumn("hash", F.when(F.col("height") > tier * DEPTH + k, up).otherwise(F.expr("kids[0].hash")))
        if k + 1 < DEPTH:
            df = df.withColumn("node", F.struct(F.col(digits[k + 1]).alias("digit"), "hash", "kids"))
    return df.select("grp", "height", "block", "hash", "kids")


def _tree(nodes: DataFrame, payload: list[str]) -> list[DataFrame]:
    """Tiers from the leaves up; the last has one row a group, with its root."""
    nodes = nodes.withColumn("height", F.expr(_height("n"))).drop("n")
    highest = nodes.agg(F.max("height")).first()[0] or 0
    tiers = [staged(_tier(nodes, 0, payload), "manifest-tier")]
    while highest > len(tiers) * DEPTH:
        up = tiers[-1].select("grp", "height", F.col("block").alias("rank"), "hash")
        tiers.append(staged(_tier(up, len(tiers), []), "manifest-tier"))
    return tiers


def _unfold(blocks: DataFrame, tier: int, keep: list[str]) -> DataFrame:
    """``blocks(grp, height, block, kids, lefts, rights, keep...)`` to one row a node of the level below: ``rank, node, lefts, rights``.

    ``lefts`` and ``rights`` hold, from a node's own level up to the root, the digests before and after it in its run.
    """
    df = blocks.withColumnRenamed("block", "rank")
    hashes = "array_join(transform(slice(kids, {}), x -> x.hash), '')"
    sides = f"transform(kids, (k, i) -> struct(k AS node, {hashes.format('1, i')} AS l, {hashes.format(f'i + 2, {ARITY}')} AS r))"
    for k in range(DEPTH - 1, -1, -1):
        hashed = f"height > {tier * DEPTH + k}"
        df = df.select("grp", "height", "rank", "lefts", "rights", *keep, F.explode(F.expr(sides)).alias("at"))
        df = df.select(
            "grp",
            "height",
            F.expr(f"rank * {ARITY} + at.node.digit").alias("rank"),
            F.expr(f"if({hashed}, concat(array(at.l), lefts), lefts)").alias("lefts"),
            F.expr(f"if({hashed}, concat(array(at.r), rights), rights)").alias("rights"),
            *keep,
            *([F.expr("at.node.kids").alias("kids")] if k else [F.expr("at.node").alias("node")]),
        )
    return df


def _proofs(tiers: list[DataFrame], above: DataFrame | None, keep: list[str]) -> DataFrame:
    """Rows of the leaves with their proofs. ``above(grp, lefts, rights, keep...)`` continues a group's proof over its root."""
    none = F.array().cast("array<string>")
    blocks = tiers[-1].select("grp", "height", "block", "kids")
    if above is None:
        df = blocks.withColumns({"lefts": none, "rights": none})
    else:
        df = blocks.join(above, "grp")
    for tier in range(len(tiers) - 1, -1, -1):
        df = _unfold(df, tier, keep)
        if tier:
            down = df.select("grp", F.col("rank").alias("block"), "lefts", "rights", *keep)
            # Written, so that the join chooses by its size on disk.
            down = staged(down, "manifest-proofs")
            df = tiers[tier - 1].select("grp", "height", "block", "kids").join(down, ["grp", "block"])
    return df


def fold(start: Column) -> Column:
    """The digest at the end of the proof ``lefts, rights`` from ``start`` on."""
    return F.aggregate(F.arrays_zip("lefts", "rights"), start, lambda got, side: F.sha2(F.concat(side["lefts"], got, side["rights"]), 256))


def manifest(docs: DataFrame, tampered: Column, text: Column) -> DataFrame:
    """Leaves, roots and inclusion proofs of ``docs(doc_id, source, lang, n_chars, text)``, checked against a second reading of its rows.

    ``tampered`` says which rows read ``text`` the second time. Returns one row per row: ``doc_id, source, rank, leaf, subroot, root,
    siblings`` (digests from the leaf's run up, concatenated), ``proof_sha256, folded_root, verified``.
    """
    own = leaves(docs, tampered, text).withColumn("salt", F.monotonically_increasing_id())
    own = staged(own, "manifest-leaves")
    tiers = _tree(ranked(own, ["doc_id", "hash", "salt"]).select("grp", "n", "rank", "hash", "doc_id", "seen"), ["doc_id", "seen"])
    tops = tiers[-1].select(F.lit("").alias("grp"), "hash", F.col("grp").alias("of"))
    upper = _tree(ranked(tops, ["of"]).select("grp", "n", "rank", "hash", "of"), ["of"])
    top = upper[-1].select("hash").first()
    above = _proofs(upper, None, []).select(F.col("node.of").alias("grp"), F.col("node.hash").alias("subroot"), "lefts", "rights")
    found = _proofs(tiers, staged(above, "manifest-subroots"), ["subroot"])
    siblings = F.array_join(F.zip_with("lefts", "rights", lambda l, r: F.concat(l, r)), "")
    root = F.lit(top[0] if top else None).cast("string")
    out = found.select(
        F.col("node.doc_id").alias("doc_id"),
        F.expr("if(grp = 'n', NULL, substr(grp, 2))").alias("source"),
        "rank",
        F.col("node.hash").alias("leaf"),
        "subroot",
        root.alias("root"),
        siblings.alias("siblings"),
        fold(F.coalesce("node.seen", "node.hash")).alias("folded_root"),
    )
    return out.withColumns({"proof_sha256": F.sha2("siblings", 256), "verified": F.col("folded_root") == F.col("root")})


def tampering() -> tuple[Column, Column]:
    """Rows whose crc32 of the decimal doc_id is even lose the line feeds of their text."""
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))


def manifest_sql() -> str:
    """The same for DuckDB: levels by recursion, proofs and folds by a second one."""
    part = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf_of = lambda text: " || ".join(part(text if c == "text" else c) for c in PARTS)
    step = "CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), ch -> [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda c, s: {step}), 4294967295)"
    crc = crc.replace("ch ->", "lambda ch:")
    tree = lambda name, base: f"""{name}_up AS (
  SELECT grp, 0 AS level, pos, n, h FROM {base}
  UNION ALL
  SELECT grp, level + 1, pos // {ARITY}, any_value((n + {ARITY - 1}) // {ARITY}), sha256(string_agg(h, '' ORDER BY pos))
  FROM {name}_up WHERE n > 1 GROUP BY grp, level, pos // {ARITY}),
{name}_kids AS (SELECT grp, level, pos, h, n, string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
  string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r
  FROM {name}_up WINDOW w AS (PARTITION BY grp, level, pos // {ARITY} ORDER BY pos))"""  # noqa: E731
    return f"""WITH RECURSIVE leafs AS (
  SELECT doc_id, source, sha256({leaf_of('text')}) AS h,
    CASE WHEN {crc} % 2 = 0 THEN sha256({leaf_of("replace(text, chr(10), '')")}) ELSE sha256({leaf_of('text')}) END AS seen
  FROM documents),
base AS (SELECT coalesce('s' || source, 'n') AS grp, doc_id, h, seen, count(*) OVER (PARTITION BY source) AS n,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leafs),
{tree('a', 'base')},
subs AS (SELECT '' AS grp, grp AS of, h, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM a_up WHERE n = 1),
{tree('b', 'subs')},
top AS (SELECT h AS root FROM b_up WHERE n = 1),
climb AS (
  SELECT b.doc_id, b.grp, b.pos AS at, b.pos, 0 AS level, 'a' AS side, b.h AS leaf, b.seen AS got, '' AS proof FROM base b
  UNION ALL
  SELECT c.doc_id, c.grp, c.at, CASE WHEN k.n = 1 THEN s.pos ELSE c.pos // {ARITY} END, CASE WHEN k.n = 1 THEN 0 ELSE c.level + 1 END,
    CASE WHEN k.n = 1 THEN CASE c.side WHEN 'a' THEN 'b' ELSE 'z' END ELSE c.side END, c.leaf,
    CASE WHEN k.n = 1 THEN c.got ELSE sha256(coalesce(k.l, '') || c.got || coalesce(k.r, '')) END,
    CASE WHEN k.n = 1 THEN c.proof ELSE c.proof || coalesce(k.l, '') || coalesce(k.r, '') END
  FROM climb c
  JOIN (SELECT 'a' AS side, * FROM a_kids UNION ALL SELECT 'b', * FROM b_kids) k
    ON k.side = c.side AND k.level = c.level AND k.pos = c.pos AND k.grp = CASE c.side WHEN 'a' THEN c.grp ELSE '' END
  JOIN subs s ON s.of = c.grp)
SELECT c.doc_id, c.leaf, s.h AS subroot, t.root, sha256(c.proof) AS proof_sha256, c.got AS folded_root, c.got = t.root AS verified
FROM climb c JOIN subs s ON s.of = c.grp CROSS JOIN top t WHERE c.side = 'z'"""
