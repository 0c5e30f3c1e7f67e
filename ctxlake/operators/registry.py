"""Provider registry rows and pointers to native semantic views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import specs

# Provider names and keys are fixed values; the texts are ours.
ENTRIES: dict[str, dict[str, str]] = {
    "dbt": {
        "overview": "# dbt\nModels, columns and edges read from compiled manifests.",
        "model": "Each row of dbt_model is one model node.",
        "column": "Each row of dbt_column is one documented column of a model.",
        "dependency": "Each row of dbt_dependency is one direct edge into a model.",
    },
    "lookml": {
        "overview": "# LookML\nViews, fields and explores read from LookML files.",
        "view": "Each row of lookml_view is one view.",
        "dimension": "Each row of lookml_dimension is one dimension or dimension group.",
        "measure": "Each row of lookml_measure is one measure.",
        "explore": "Each row of lookml_explore is one explore.",
    },
    "omni": {
        "overview": "# Omni\nViews, fields and topics read from Omni YAML files.",
        "view": "Each row of omni_view is one view.",
        "dimension": "Each row of omni_dimension is one dimension.",
        "measure": "Each row of omni_measure is one measure.",
        "topic": "Each row of omni_topic is one topic.",
        "topic_join": "Each row of omni_topic_join is one join edge inside a topic.",
    },
    "osi": {
        "overview": "# OSI\nSemantic models read from Open Semantic Interchange documents.",
        "model": "Each row of osi_model is one semantic model.",
        "dataset": "Each row of osi_dataset is one dataset of a model.",
        "field": "Each row of osi_field is one field of a dataset.",
        "metric": "Each row of osi_metric is one metric of a model.",
        "relationship": "Each row of osi_relationship joins two datasets.",
    },
    "skills": {
        "overview": "# Skills\nMarkdown instructions kept as registry rows.",
        "root-convention": "A registry row whose key starts with skill/ is a skill.",
        "skill_use": "Each row of skill_use is one schema or table a skill declares.",
    },
    "snowflake_semantic": {
        "overview": "# Semantic views\nEach key semantic_view/<name> points to one native semantic view.",
    },
    "notes_on": {
        "overview": "# Notes\nNotes attached to schemas, tables and columns.",
        "schemata": "Each row of notes_on_schemata is one note on a schema.",
        "tables": "Each row of notes_on_tables is one note on a table.",
        "columns": "Each row of notes_on_columns is one note on a column.",
    },
}
POINTER_PROVIDER = "snowflake_semantic"
POINTER_PREFIX = "semantic_view/"
SKILL_PREFIX = "skill/"


def root_entries(spark: SparkSession, *providers: str) -> DataFrame:
    """The fixed rows of the named providers (all when none is named)."""
    unknown = set(providers) - set(ENTRIES)
    if unknown:
        raise ValueError(f"unknown provider: {sorted(unknown)[0]}")
    rows = [(p, k, text) for p in providers or ENTRIES for k, text in ENTRIES[p].items()]
    return spark.createDataFrame(rows, specs.ROOT.schema)


def semantic_view_names(names: DataFrame | Iterable[str], spark: SparkSession | None = None) -> DataFrame:
    """Trimmed, distinct names. An empty name or an empty list is an error."""
    if not isinstance(names, DataFrame):
        names = spark.createDataFrame([(n,) for n in names], "name string")
    trimmed = names.select(F.regexp_replace(F.col(names.columns[0]), r"^\s+|\s+$", "").alias("name"))
    if not trimmed.filter("name = '' OR name IS NULL").isEmpty():
        raise ValueError("a semantic view name is empty")
    distinct = trimmed.distinct()
    if distinct.isEmpty():
        raise ValueError("no semantic view name given")
    return distinct


def pointer_rows(names: DataFrame) -> DataFrame:
    content = F.format_string(
        "# Semantic view\n\nObject: `%s`\n\nDimensions, metrics and relationships are defined in that object.",
        F.col("name"),
    )
    return specs.ROOT.conform(
        names.select(
            F.lit(POINTER_PROVIDER).alias("provider"),
            F.concat(F.lit(POINTER_PREFIX), "name").alias("key"),
            content.alias("content"),
        )
    )


def listing(root: DataFrame) -> DataFrame:
    return root.orderBy("provider", "key")


def skill_listing(root: DataFrame) -> DataFrame:
    return root.filter(F.col("key").startswith(SKILL_PREFIX)).orderBy("provider", "key")


def pointer_listing(root: DataFrame) -> DataFrame:
    pointers = root.filter(
        (F.col("provider") == POINTER_PROVIDER) & F.col("key").startswith(POINTER_PREFIX)
    )
    return pointers.select("key", "content").orderBy("key")


def present_families(root: DataFrame, frame: DataFrame, provider: str = "provider") -> DataFrame:
    """Rows of ``frame`` whose provider is registered."""
    registered = root.select(F.col("provider").alias(provider)).distinct()
    return frame.join(registered, provider, "left_semi")
