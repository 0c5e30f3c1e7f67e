"""LookML blocks → lookml_view, lookml_dimension, lookml_measure, lookml_explore."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import specs
from ..functions.text import yes_or_true


def _source() -> Column:
    return F.col("file_path").alias(specs.SOURCE_FILE)


def _props(*names: str) -> list[Column]:
    return [F.col("props")[n].alias(n) for n in names]


def views(blocks: DataFrame, spec: specs.TableSpec = specs.LOOKML_VIEW) -> DataFrame:
    """``spec`` may be ``by_file()``: then rows carry the file they came from."""
    return spec.conform(
        blocks.filter("kind = 'view'").select(
            _source(),
            "name", *_props("sql_table_name", "label", "description", "ai_context"), "file_path"
        )
    )


def dimensions(blocks: DataFrame, spec: specs.TableSpec = specs.LOOKML_DIMENSION) -> DataFrame:
    return spec.conform(
        blocks.filter(F.col("kind").isin("dimension", "dimension_group")).select(
            _source(),
            "view_name",
            F.col("name").alias("field_name"),
            F.col("kind").alias("field_kind"),
            *_props("type", "sql", "description", "ai_context"),
            yes_or_true(F.col("props")["primary_key"]).alias("primary_key"),
        )
    )


def measures(blocks: DataFrame, spec: specs.TableSpec = specs.LOOKML_MEASURE) -> DataFrame:
    return spec.conform(
        blocks.filter("kind = 'measure'").select(
            _source(),
            "view_name",
            F.col("name").alias("measure_name"),
            *_props("type", "sql", "description", "ai_context", "filters"),
        )
    )


def explores(blocks: DataFrame, spec: specs.TableSpec = specs.LOOKML_EXPLORE) -> DataFrame:
    return spec.conform(
        blocks.filter("kind = 'explore'").select(
            _source(),
            "name",
            F.coalesce(F.nullif(F.col("props")["from"], F.lit("")), F.col("name")).alias("from_view"),
            *_props("label", "description", "ai_context"),
            "file_path",
        )
    )


def rejects(blocks: DataFrame) -> DataFrame:
    return blocks.filter("error IS NOT NULL").select("file_path", F.col("error").alias("message"))


def family(blocks: DataFrame) -> dict[str, DataFrame]:
    return {
        "lookml_view": views(blocks),
        "lookml_dimension": dimensions(blocks),
        "lookml_measure": measures(blocks),
        "lookml_explore": explores(blocks),
    }


def family_by_file(blocks: DataFrame) -> dict[str, DataFrame]:
    """The same with the file each row came from."""
    makers = {specs.LOOKML_VIEW: views, specs.LOOKML_DIMENSION: dimensions, specs.LOOKML_MEASURE: measures, specs.LOOKML_EXPLORE: explores}
    return {spec.name: make(blocks, spec.by_file()) for spec, make in makers.items()}
