"""Compiled transformation manifests: one row per node."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .scan import relative_path

# ``meta`` is declared STRING, so nested JSON arrives as its raw text.
NODE = (
    "STRUCT<resource_type: STRING, name: STRING, database: STRING, `schema`: STRING, "
    "description: STRING, original_file_path: STRING, "
    "config: STRUCT<materialized: STRING, meta: STRING>, meta: STRING, tags: ARRAY<STRING>, "
    "`columns`: MAP<STRING, STRUCT<data_type: STRING, description: STRING>>, "
    "depends_on: STRUCT<nodes: ARRAY<STRING>>>"
)
MANIFEST = f"nodes MAP<STRING, {NODE}>"


def read_manifests(spark: SparkSession, base: str, *, multiline: bool = True) -> DataFrame:
    """Every ``target/manifest.json`` below ``base``.

    ``multiline=False`` reads line-delimited files holding one manifest per line,
    which split across tasks; a single pretty-printed manifest does not. A corrupt
    manifest, or one without nodes, comes as a row with null ``nodes``: see ``rejects``.
    """
    reader = spark.read.schema(MANIFEST).option("multiLine", str(multiline).lower())
    if multiline:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "manifest.json")
    try:
        frame = reader.json(base).select(relative_path(base).alias("file_path"), "nodes")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no compiled manifest found below {base}") from error
        raise
    if multiline:
        frame = frame.filter(
            (F.col("file_path") == "target/manifest.json")
            | F.col("file_path").endswith("/target/manifest.json")
        )
    return frame


def load_manifests(spark: SparkSession, base: str) -> DataFrame:
    """As ``read_manifests``, raising FileNotFoundError when there is none."""
    frame = read_manifests(spark, base)
    if frame.select("file_path").isEmpty():
        raise FileNotFoundError(f"no compiled manifest found below {base}")
    return frame


def rejects(manifests: DataFrame) -> DataFrame:
    """``(file_path, message)`` of manifests that are corrupt or have no nodes."""
    return manifests.filter("nodes IS NULL").select("file_path", F.lit("corrupt, or without nodes").alias("message"))


def manifests_from_text(docs: DataFrame) -> DataFrame:
    return docs.select(
        "file_path", F.from_json("content", MANIFEST).getField("nodes").alias("nodes")
    )
