"""Note context per warehouse object."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import specs
from ..runtime import staged

OBJECT_KEYS = {
    "notes_on_schemata": ("schema_name",),
    "notes_on_tables": ("table_catalog", "table_schema", "table_name"),
    "notes_on_columns": ("table_catalog", "table_schema", "table_name", "column_name"),
}
NOTE_FIELDS = tuple(c for c in specs.NOTES_ON_SCHEMATA.columns if c != "schema_name")


def summary(notes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count and highest importance per object; a null key is a group of its own."""
    return notes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("notes_on_count"),
        F.max("importance").alias("notes_on_highest_importance"),
    )


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])


def _summary_by(notes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Written, so that joins see how small it is."""
    return staged(summary(notes, keys).withColumnsRenamed({k: f"_k_{k}" for k in keys}), "note-summary")


def context(notes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per note: the keys and fields of the note with count and highest importance of its object.

    The shape is the same however many notes an object has; no task gathers them.
    """
    found = notes.join(_summary_by(notes, keys), _same(keys))
    return found.select(*keys, *NOTE_FIELDS, "notes_on_count", "notes_on_highest_importance")


def top_context(notes: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """One row per object: count, highest importance and its ``k`` first notes of ``top_notes`` as an array."""
    best = top_notes(notes, keys, k).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", F.struct(*NOTE_FIELDS).alias("note")))).alias("best"))
    return best.join(_summary_by(notes, keys), _same(keys)).select(
        *keys, "notes_on_count", "notes_on_highest_importance", F.transform("best", lambda n: n["note"]).alias("notes_on_notes")
    )


def create_context_views(tables: dict[str, DataFrame], k: int, prefix: str = "") -> list[str]:
    """Temporary views ``notes_on_..._context``, one per note table given, with one row per object and its ``k`` first notes."""
    names = []
    for table, rows in tables.items():
        top_context(rows, OBJECT_KEYS[table], k).createOrReplaceTempView(f"{prefix}{table}_context")
        names.append(f"{prefix}{table}_context")
    return names


def top_notes(notes: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most important notes per object, then by confidence, then by id.

    The rank filter also runs per task before the shuffle, so a busy object sends
    at most ``k`` rows per task.
    """
    order = Window.partitionBy(*keys).orderBy(
        F.col("importance").desc_nulls_last(), F.col("confidence").desc_nulls_last(), F.col("note_id")
    )
    return notes.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def pick_notes(notes: DataFrame, *, kind: str | None = None, tag: str | None = None) -> DataFrame:
    if kind is not None:
        notes = notes.filter(F.col("kind") == kind)
    if tag is not None:
        notes = notes.filter(F.array_contains("tags", tag))
    return notes


def enrich(objects: DataFrame, object_context: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Catalog objects with their note context; objects without notes stay."""
    renamed = object_context.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return objects.join(renamed, _same(keys), "left").drop(*[f"_k_{k}" for k in keys])
