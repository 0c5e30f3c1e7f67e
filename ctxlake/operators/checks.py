"""Checks over catalog tables, each returned as a violation DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..specs import ALL_TABLES, TableSpec


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row: ``(*keys, uses)``."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("uses")).filter("uses > 1")


def missing_values(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Null counts of required columns, one pass: ``(table_name, column_name, nulls)``."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in spec.required])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in spec.required]
    )
    return (
        counts.select(F.lit(spec.name).alias("table_name"), F.inline(pairs))
        .filter("nulls > 0")
    )


# Child table, its columns, parent table, its columns, and which child rows count.
REFERENCES = (
    ("dbt_column", ("model_id",), "dbt_model", ("unique_id",), None),
    ("dbt_dependency", ("upstream_id",), "dbt_model", ("unique_id",), "upstream_type = 'model'"),
    ("osi_relationship", ("model_name", "from_dataset"), "osi_dataset", ("model_name", "name"), None),
    ("osi_relationship", ("model_name", "to_dataset"), "osi_dataset", ("model_name", "name"), None),
    ("skill_use", ("provider", "skill_key"), "root", ("provider", "key"), None),
    ("lookml_dimension", ("view_name",), "lookml_view", ("name",), None),
    ("lookml_measure", ("view_name",), "lookml_view", ("name",), None),
    ("omni_dimension", ("view_name",), "omni_view", ("view_name",), None),
    ("omni_measure", ("view_name",), "omni_view", ("view_name",), None),
    ("omni_topic_join", ("topic_name",), "omni_topic", ("topic_name",), None),
)


def reference_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Broken references implied by the keys: ``(rule, reference, uses)``, ``uses`` counting the rows that hold one.

    Keys of parents and references of children meet in one grouping for all rules, so there is one shuffle, and a key
    that very many rows refer to is one row a task in it. Null references are not checked; rules whose child or parent
    table is not given are left out.
    """
    chosen = [(k, r) for k, r in enumerate(REFERENCES) if r[0] in tables and r[2] in tables]
    if not chosen:
        raise ValueError("no pair of a child and its parent table was given")
    parents = {(parent, columns) for _, (_, _, parent, columns, _) in chosen}
    key = lambda columns: F.array(*[F.col(c).cast("string") for c in columns]).alias("key")
    sides = [
        tables[parent].select(F.lit(parent).alias("parent"), key(columns), F.lit(None).cast("int").alias("k"))
        for parent, columns in sorted(parents)
    ]
    for k, (child, columns, parent, _, only) in chosen:
        rows = tables[child] if only is None else tables[child].filter(only)
        filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        sides.append(rows.filter(filled).select(F.lit(parent).alias("parent"), key(columns), F.lit(k).alias("k")))
    counts = [F.count_if(F.col("k") == k).alias(f"n{k}") for k, _ in chosen]
    met = _union(sides).groupBy("parent", "key").agg(F.count_if(F.col("k").isNull()).alias("held"), *counts)
    name = lambda rule: ".".join((rule[0], next(c for c in rule[1] if c not in ("model_name", "provider"))))
    found = F.array(*[F.struct(F.lit(name(r)).alias("rule"), F.col(f"n{k}").alias("uses")) for k, r in chosen])
    broken = met.filter("held = 0").select(F.array_join("key", "/").alias("reference"), F.inline(found))
    return broken.filter("uses > 0").select("rule", "reference", "uses")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per output table: ``(table_name, n)``."""
    return _union(
        [
            rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
            for name, rows in tables.items()
        ]
    )


def key_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated keys over many tables: ``(table_name, key, uses)``."""
    return _union(
        [
            repeated_keys(rows, ALL_TABLES[name].keys).select(
                F.lit(name).alias("table_name"),
                F.concat_ws("/", *ALL_TABLES[name].keys).alias("key"),
                "uses",
            )
            for name, rows in tables.items()
        ]
    )


def null_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([missing_values(rows, ALL_TABLES[name]) for name, rows in tables.items()])
