"""Manifest nodes → dbt_model, dbt_column, dbt_dependency."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import specs
from ..functions.text import first_filled_json, prefix_or, text_or_blank


def model_nodes(manifests: DataFrame) -> DataFrame:
    """One row per node of type model: ``uid``, ``node``."""
    exploded = manifests.select("file_path", F.explode("nodes").alias("uid", "node"))
    return exploded.filter(F.col("node.resource_type") == "model")


def models(nodes: DataFrame) -> DataFrame:
    node = F.col("node")
    return specs.DBT_MODEL.conform(
        nodes.filter(node["name"].isNotNull()).select(
            F.col("uid").alias("unique_id"),
            node["name"].alias("name"),
            node["database"].alias("database_name"),
            node["schema"].alias("schema_name"),
            node["config"]["materialized"].alias("materialization"),
            text_or_blank(node["description"]).alias("description"),
            node["original_file_path"].alias("file_path"),
            F.coalesce(node["tags"], F.array().cast("array<string>")).alias("tags"),
            first_filled_json(node["config"]["meta"], node["meta"]).alias("meta"),
        )
    )


def unnamed_models(nodes: DataFrame) -> DataFrame:
    """Model nodes that cannot become rows because they carry no name."""
    return nodes.filter(F.col("node.name").isNull()).select(
        "file_path", F.col("uid").alias("unique_id"), F.lit("model node has no name").alias("message")
    )


def columns(nodes: DataFrame) -> DataFrame:
    return specs.DBT_COLUMN.conform(
        nodes.select(F.col("uid").alias("model_id"), F.explode("node.columns").alias("column_name", "c")).select(
            "model_id",
            "column_name",
            text_or_blank(F.col("c.data_type")).alias("data_type"),
            text_or_blank(F.col("c.description")).alias("description"),
        )
    )


def dependencies(nodes: DataFrame) -> DataFrame:
    """One row per distinct edge. Repeats sit inside one node, so no shuffle is needed."""
    upstream = F.explode(F.array_distinct(F.col("node.depends_on.nodes")))
    return specs.DBT_DEPENDENCY.conform(
        nodes.select(upstream.alias("upstream_id"), F.col("uid").alias("downstream_id")).select(
            "upstream_id",
            "downstream_id",
            prefix_or(F.col("upstream_id"), ".", "unknown").alias("upstream_type"),
            F.lit("model").alias("downstream_type"),
        )
    )


def family(nodes: DataFrame) -> dict[str, DataFrame]:
    return {
        "dbt_model": models(nodes),
        "dbt_column": columns(nodes),
        "dbt_dependency": dependencies(nodes),
    }
