"""Keyword search, matching across sources, and skills usable for an object."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import search_text
from ..runtime import spread, staged

# Searched text columns per table.
SEARCH_COLUMNS = {
    "osi_metric": ("name", "description", "ai_context"),
    "lookml_measure": ("measure_name", "description", "ai_context"),
    "omni_measure": ("measure_name", "description"),
    "root": ("key", "content"),
}


def keyword_hits(rows: DataFrame, columns: Sequence[str], keywords: Sequence[str], *, literal: bool = False) -> DataFrame:
    """``rows`` plus ``keyword``, one row per keyword found in the joined text.

    ``%`` and ``_`` in a keyword are wildcards unless ``literal``. The keywords are
    constants of the plan, so many keywords still read the rows once.
    """
    text = search_text(*[F.col(c) for c in columns])

    def hit(keyword: str) -> Column:
        word = keyword.lower()
        found = F.contains(text, F.lit(word)) if literal else text.like(f"%{word}%")
        return F.when(found, F.lit(keyword))

    hits = F.array_compact(F.array(*[hit(k) for k in keywords]))
    return rows.withColumn("keyword", F.explode(hits))


def search(rows: DataFrame, table: str, keywords: Sequence[str], **options) -> DataFrame:
    return keyword_hits(rows, SEARCH_COLUMNS[table], keywords, **options)


def keyword_outcome(rows: DataFrame, table: str, keywords: Sequence[str], **options) -> DataFrame:
    """Hits per keyword, zero included: ``(keyword, hits)``."""
    hits = search(rows, table, keywords, **options).groupBy("keyword").agg(F.count(F.lit(1)).alias("hits"))
    asked = rows.sparkSession.createDataFrame([(k,) for k in dict.fromkeys(keywords)], "keyword string")
    return asked.join(hits, "keyword", "left").select(
        "keyword", F.coalesce("hits", F.lit(0)).cast("long").alias("hits")
    )


NEAR = 3
GRAMS = (3, 6)


def _near_key(before: Column, after: Column, literal: bool) -> tuple[Column, Column, Column]:
    """Up to ``NEAR`` fixed characters on each side of the dot, and their lengths."""
    left = before if literal else F.substring_index(before, "_", -1)
    right = after if literal else F.substring_index(after, "_", 1)
    left, right = F.right(left, F.lit(NEAR)), F.left(right, F.lit(NEAR))
    return F.concat(left, F.lit("."), right), F.length(left), F.length(right)


def _pieces(text: Column, size: int) -> Column:
    """All substrings of ``size`` characters; a shorter text is one."""
    last = F.greatest(F.length(text) - (size - 1), F.lit(1))
    return F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(text, i, F.lit(size)))


def _starred_matches(candidates: DataFrame, starred: DataFrame) -> DataFrame:
    """References and patterns with ``%`` that share the part around the dot and the rarest gram of the pattern's other parts.

    Every fixed run of a pattern occurs in a reference it matches. Of the grams of these runs (of the longest size of ``GRAMS`` that fits)
    the one that the fewest references hold is an equi-join key, so patterns that begin alike do not meet every reference that
    does. A pattern without a run of that length has the empty gram, which all references hold.
    """
    rest = F.concat(
        F.expr("left(_s, length(_s) - _before)"), F.lit("%"), F.expr("substr(_n, _after + 1)")
    )
    short, long = GRAMS
    runs = F.filter(F.split(rest, "[%_]"), lambda r: F.length(r) >= short)
    of_run = lambda r: F.when(F.length(r) >= long, _pieces(r, long)).otherwise(_pieces(r, short))
    grams = F.array_distinct(F.flatten(F.transform(runs, of_run)))
    grams = F.when(F.size(grams) > 0, grams).otherwise(F.array(F.lit("")))
    wanted = starred.select("_s", "_n", "_before", "_after").distinct().select("_s", "_n", F.explode(grams).alias("_gram"))
    wanted = staged(wanted, "pattern-grams")
    held = F.array_distinct(F.concat(F.array(F.lit("")), *[_pieces(F.col("_ref"), size) for size in GRAMS]))
    pieces = staged(starred.select("_mask", "_piece").distinct(), "starred-pieces")
    open_ = staged(candidates.join(pieces, ["_mask", "_piece"], "left_semi"), "starred-candidates")
    exploded = spread(open_.select("_ref").distinct()).select(F.explode(held).alias("_gram"))
    known = staged(wanted.select("_gram").distinct(), "grams")
    uses = exploded.join(known, "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_uses"))
    rarest = wanted.join(uses, "_gram", "left").groupBy("_s", "_n").agg(
        F.min_by("_gram", F.struct(F.coalesce("_uses", F.lit(0)), "_gram")).alias("_gram")
    )
    rarest = staged(rarest, "rarest-grams")
    chosen = staged(rarest.select("_gram").distinct(), "chosen-grams")
    near = spread(open_).select("*", F.explode(held).alias("_gram")).join(chosen, "_gram", "left_semi")
    return near.join(starred.join(rarest, ["_s", "_n"]), ["_mask", "_piece", "_gram"]).drop("_gram")


def match_views_to_models(views: DataFrame, models: DataFrame, *, literal: bool = False) -> DataFrame:
    """Left join of view references with models named inside them.

    A model matches where ``schema.name``, ignoring case, occurs in the view's
    ``sql_table_name``; ``_`` and ``%`` in a name are LIKE wildcards unless
    ``literal``. The result equals the plain LIKE join, without comparing every
    view with every model:

    The dot between schema and name is always a fixed character, and ``_`` stands
    for exactly one, so the text around a dot of the reference, with the wildcard
    positions blanked, must equal the pattern. Three equi-joins narrow it down: the
    few fixed characters next to the dot give the lengths that can apply there, the
    last fixed characters at that length give the wildcard positions, and the text
    blanked at these positions is the pattern itself. Many models sharing a prefix
    therefore cost a reference one row per length, not one per model, and a hot name
    costs its true matches. Patterns with ``%`` are joined on the part around the
    dot and a rare gram of the rest, and checked with LIKE.
    """
    patterns = models.filter("schema_name IS NOT NULL AND name IS NOT NULL").select(
        F.col("unique_id").alias("dbt_model_id"),
        F.col("name").alias("dbt_model"),
        "schema_name",
        F.col("description").alias("dbt_description"),
        F.lower("schema_name").alias("_s"),
        F.lower("name").alias("_n"),
    )
    before = F.col("_s") if literal else F.substring_index("_s", "%", -1)
    after = F.col("_n") if literal else F.substring_index("_n", "%", 1)
    blank = r"(?s)." if literal else r"[^_]"
    near, near_left, near_right = _near_key(before, after, literal)
    tail = F.right(after if literal else F.substring_index(after, "_", -1), F.lit(NEAR))
    piece = F.concat(before, F.lit("."), after)
    patterns = patterns.select(
        "*",
        piece.alias("_piece"),
        F.regexp_replace(piece, blank, "x").alias("_mask"),
        F.length(before).alias("_before"),
        F.length(after).alias("_after"),
        near.alias("_near"),
        near_left.alias("_near_left"),
        near_right.alias("_near_right"),
        tail.alias("_tail"),
        F.length(tail).alias("_tail_size"),
        F.contains(F.concat("_s", F.lit("."), "_n"), F.lit("%")).alias("_percent"),
    )
    # Written, so that joins choose by real sizes: what they are made of may be far smaller than what they expand to.
    patterns = staged(patterns, "patterns")
    at_dot = ["_near", "_near_left", "_near_right"]
    at_end = [*at_dot, "_before", "_after", "_tail_size"]
    shapes = staged(patterns.select(*at_end, "_tail", "_mask").distinct(), "shapes")
    lengths = staged(shapes.select(*at_end).distinct(), "lengths")

    refs = spread(views.select(F.lower("sql_table_name").alias("_ref")).filter("_ref IS NOT NULL").distinct())
    size = F.length("_ref")
    dots = F.filter(
        F.sequence(F.lit(1), F.greatest(size, F.lit(1))),
        lambda i: F.substr(F.col("_ref"), i, F.lit(1)) == ".",
    )
    spans = F.array(
        *[
            F.struct(F.lit(a).alias("_near_left"), F.lit(b).alias("_near_right"))
            for a in range(NEAR + 1)
            for b in range(NEAR + 1)
        ]
    )
    windows = (
        refs.select("_ref", F.explode(dots).alias("_dot"))
        .select("_ref", "_dot", F.inline(spans))
        .filter(F.col("_dot") > F.col("_near_left"))
        .filter(F.col("_dot") + F.col("_near_right") <= size)
        .withColumn(
            "_near",
            F.substr(
                F.col("_ref"),
                F.col("_dot") - F.col("_near_left"),
                F.col("_near_left") + F.col("_near_right") + 1,
            ),
        )
    )
    around = F.substr(
        F.col("_ref"), F.col("_dot") - F.col("_before"), F.col("_before") + F.col("_after") + 1
    )
    blanked = F.array_join(
        F.zip_with(
            F.split(around, ""), F.split("_mask", ""), lambda c, m: F.when(m == "_", m).otherwise(c)
        ),
        "",
    )
    has_wildcard = F.lit(False) if literal else F.contains("_mask", F.lit("_"))
    end = F.substr(F.col("_ref"), F.col("_dot") + F.col("_after") - F.col("_tail_size") + 1, F.col("_tail_size"))
    candidates = (
        windows.join(lengths, at_dot)
        .filter(F.col("_dot") > F.col("_before"))
        .filter(F.col("_dot") + F.col("_after") <= size)
        .withColumn("_tail", end)
        .join(shapes, [*at_end, "_tail"])
        .select("_ref", "_mask", F.when(has_wildcard, blanked).otherwise(around).alias("_piece"))
        .distinct()
    )
    if literal:
        matches = candidates.join(patterns, ["_mask", "_piece"])
    else:
        candidates = staged(candidates, "candidates")
        full = "concat('%', replace(_s, '!', '!!'), '.', replace(_n, '!', '!!'), '%')"
        starred = _starred_matches(candidates, patterns.filter("_percent"))
        starred = starred.filter(f"_ref LIKE {full} ESCAPE '!'")
        matches = candidates.join(patterns.filter("NOT _percent"), ["_mask", "_piece"]).unionByName(starred)
    matches = matches.select("_ref", "dbt_model_id", "dbt_model", "schema_name", "dbt_description")
    return (
        views.select(F.col("name").alias("lookml_view"), "sql_table_name", F.lower("sql_table_name").alias("_ref"))
        .join(matches, "_ref", "left")
        .drop("_ref")
    )


def attach_model_docs(frame: DataFrame, models: DataFrame, schema: str, table: str) -> DataFrame:
    """Left equi-join of (schema, table) with model documentation, ignoring case."""
    docs = models.select(
        F.lower("schema_name").alias("_s"),
        F.lower("name").alias("_n"),
        F.col("unique_id").alias("dbt_model_id"),
        F.col("description").alias("dbt_description"),
    )
    return frame.join(
        docs, (F.lower(frame[schema]) == docs["_s"]) & (F.lower(frame[table]) == docs["_n"]), "left"
    ).drop("_s", "_n")


def attach_column_docs(frame: DataFrame, columns: DataFrame, column: str) -> DataFrame:
    """Left equi-join of (dbt_model_id, column) with column documentation, ignoring case."""
    docs = columns.select(
        F.col("model_id").alias("_m"),
        F.lower("column_name").alias("_c"),
        "data_type",
        F.col("description").alias("column_description"),
    )
    return frame.join(
        docs, (frame["dbt_model_id"] == docs["_m"]) & (F.lower(frame[column]) == docs["_c"]), "left"
    ).drop("_m", "_c")


def _grants(skill_use: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Schema grants, and table grants not already covered by one of the same skill."""
    schema = skill_use.filter("use_kind = 'schema'").select(
        "provider", "skill_key", F.col("object_ref").alias("schema_name")
    )
    table = skill_use.filter("use_kind = 'table'").select(
        "provider",
        "skill_key",
        F.substring_index("object_ref", ".", 1).alias("schema_name"),
        F.expr("substring(object_ref, instr(object_ref, '.') + 1)").alias("table_name"),
    )
    extra = table.join(schema, ["provider", "skill_key", "schema_name"], "left_anti")
    return schema.distinct(), extra.distinct()


def granted_objects(skill_use: DataFrame) -> DataFrame:
    """``(schema_name, table_name)`` of every object granted by name, also of those that no longer exist."""
    return skill_use.filter("use_kind = 'table'").select(
        F.substring_index("object_ref", ".", 1).alias("schema_name"),
        F.expr("substring(object_ref, instr(object_ref, '.') + 1)").alias("table_name"),
    ).distinct()


def usable_skills(skill_use: DataFrame, objects: DataFrame) -> DataFrame:
    """Skills each ``(schema_name, table_name)`` may be answered with.

    Grants add up: a schema grant covers all its tables. Overlap is removed between
    the grants, so the pairs need no distinct.
    """
    schema, table = _grants(skill_use)
    wanted = objects.select("schema_name", "table_name").distinct()
    columns = ["schema_name", "table_name", "provider", "skill_key"]
    return (
        wanted.join(schema, "schema_name").select(*columns)
        .unionByName(wanted.join(table, ["schema_name", "table_name"]).select(*columns))
    )


def usable_skill_counts(skill_use: DataFrame, objects: DataFrame) -> DataFrame:
    """How many skills each object may be answered with, counted before joining."""
    schema, table = _grants(skill_use)
    per_schema = schema.groupBy("schema_name").agg(F.count(F.lit(1)).alias("by_schema"))
    per_table = table.groupBy("schema_name", "table_name").agg(F.count(F.lit(1)).alias("by_table"))
    total = F.coalesce("by_schema", F.lit(0)) + F.coalesce("by_table", F.lit(0))
    return (
        objects.select("schema_name", "table_name")
        .distinct()
        .join(per_schema, "schema_name", "left")
        .join(per_table, ["schema_name", "table_name"], "left")
        .select("schema_name", "table_name", total.alias("skills"))
    )


def skills_for(skill_use: DataFrame, schema_name: str, table_name: str) -> DataFrame:
    """Skills usable for one object; filters reach the scan."""
    mine = ((F.col("use_kind") == "schema") & (F.col("object_ref") == schema_name)) | (
        (F.col("use_kind") == "table") & (F.col("object_ref") == f"{schema_name}.{table_name}")
    )
    return skill_use.filter(mine).select("provider", "skill_key").distinct()
