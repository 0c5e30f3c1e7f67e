"""Graph operators over edge-list DataFrames.

Every loop keeps one small frontier per round. A round is one job: semi-join the
edges with the frontier, drop what was reached before, write the rest. The
reached set is a parquet folder partitioned by round, so lineage never grows,
a lost executor costs one task, and the round number is the distance.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame, functions as F, types as T

from ..runtime import run_folder, scratch, write_counted


def closure(
    edges: DataFrame,
    start: DataFrame,
    *,
    source: str,
    target: str,
    group: Sequence[str] = (),
) -> DataFrame:
    """Nodes reached from ``start`` over one or more edges: ``(*group, node_id, depth)``.

    ``start`` holds ``(*group, node_id)``. With ``group`` each group walks only
    its own edges, all groups at once. A start node is in the result only if a
    path leads back to it. ``depth`` is the shortest distance. Cycles end by
    themselves because a node enters the frontier once.

    No side is forced to broadcast: a small frontier is broadcast by its measured
    size, a big one shuffles and adaptive execution splits a hub's edges.
    """
    group = list(group)
    walk = edges.select(
        *group, F.col(source).alias("from_node"), F.col(target).alias("node_id")
    ).filter("from_node IS NOT NULL AND node_id IS NOT NULL")
    frontier = start.select(*group, F.col("node_id").alias("from_node")).distinct()
    with scratch(walk, "edges") as walk:
        return _walked(walk, frontier, [*group, "node_id"])


def _walked(walk: DataFrame, frontier: DataFrame, keys: list[str]) -> DataFrame:
    spark, group = walk.sparkSession, keys[:-1]
    folder = run_folder(spark, "reached")
    node_schema = T.StructType(walk.select(*keys).schema.fields).add("depth", T.IntegerType())
    for depth in count(1):
        found = walk.join(frontier, [*group, "from_node"], "left_semi").select(*keys).distinct()
        if depth > 1:
            reached = spark.read.schema(node_schema).parquet(folder)
            found = found.join(reached, keys, "left_anti")
        this_round = f"{folder}/depth={depth}"
        if write_counted(found, this_round) == 0:
            return spark.read.schema(node_schema).parquet(folder)
        frontier = spark.read.schema(found.schema).parquet(this_round).select(
            *group, F.col("node_id").alias("from_node")
        )


def downstream(edges: DataFrame, start: DataFrame, **options) -> DataFrame:
    return closure(edges, start, source="upstream_id", target="downstream_id", **options)


def upstream(edges: DataFrame, start: DataFrame, **options) -> DataFrame:
    return closure(edges, start, source="downstream_id", target="upstream_id", **options)


def lineage_models(edges: DataFrame, models: DataFrame, start: DataFrame) -> DataFrame:
    """Distinct ``(name, schema_name, description)`` of models downstream of ``start``."""
    reached = downstream(edges, start)
    return (
        models.join(reached, models["unique_id"] == reached["node_id"], "left_semi")
        .select("name", "schema_name", "description")
        .distinct()
    )


def reachable_views(topics: DataFrame, topic_joins: DataFrame) -> DataFrame:
    """Views reachable from each topic's base view: ``(topic_name, view_name, depth)``."""
    start = topics.select("topic_name", F.col("base_view").alias("node_id"))
    reached = closure(
        topic_joins, start, source="from_view", target="to_view", group=["topic_name"]
    )
    return reached.withColumnRenamed("node_id", "view_name")


def join_paths(relationships: DataFrame) -> DataFrame:
    """For all models at once, the shortest relationship path between datasets.

    ``(model_name, from_dataset, to_dataset, hops, path)``; ``path`` lists relationship
    names. Of equally short paths the alphabetically first is kept.
    """
    steps = relationships.select(
        "model_name", "from_dataset", "to_dataset", F.col("name").alias("relationship")
    )
    with scratch(steps, "relationships") as steps:
        return _chained(steps)


def _chained(steps: DataFrame) -> DataFrame:
    spark = steps.sparkSession
    keys = ["model_name", "from_dataset", "to_dataset"]
    folder = run_folder(spark, "paths")

    def shortest(frame: DataFrame) -> DataFrame:
        return frame.groupBy(*keys).agg(F.min("path").alias("path"))

    found = shortest(steps.select(*keys, F.array("relationship").alias("path")))
    path_schema = T.StructType(found.schema.fields).add("hops", T.IntegerType())
    for hops in count(1):
        this_round = f"{folder}/hops={hops}"
        if write_counted(found, this_round) == 0:
            return spark.read.schema(path_schema).parquet(folder).select(*keys, "hops", "path")
        last = spark.read.schema(found.schema).parquet(this_round)
        known = spark.read.schema(path_schema).parquet(folder)
        nxt = steps.select(
            "model_name", F.col("from_dataset").alias("via"), F.col("to_dataset").alias("far"), "relationship"
        )
        longer = (
            last.join(nxt, (last["model_name"] == nxt["model_name"]) & (last["to_dataset"] == nxt["via"]))
            .filter(F.col("far") != F.col("from_dataset"))
            .select(
                last["model_name"],
                "from_dataset",
                F.col("far").alias("to_dataset"),
                F.concat("path", F.array("relationship")).alias("path"),
            )
        )
        found = shortest(longer).join(known, keys, "left_anti")
