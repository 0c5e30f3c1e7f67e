"""Open Semantic Interchange documents → the five osi tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import specs
from ..functions.text import text_or_blank

_EXTRAS = "ai_context: VARIANT, custom_extensions: ARRAY<STRUCT<vendor_name: STRING, data: STRING>>"
_EXPRESSION = "expression: STRUCT<dialects: ARRAY<STRUCT<dialect: STRING, expression: STRING>>>"
_FIELD = (
    f"STRUCT<name: STRING, label: STRING, description: STRING, dimension: STRUCT<is_time: BOOLEAN>, "
    f"{_EXPRESSION}, {_EXTRAS}>"
)
_DATASET = (
    "STRUCT<name: STRING, source: STRING, primary_key: ARRAY<STRING>, "
    "unique_keys: ARRAY<ARRAY<STRING>>, description: STRING, "
    f"fields: ARRAY<{_FIELD}>, {_EXTRAS}>"
)
_METRIC = f"STRUCT<name: STRING, description: STRING, {_EXPRESSION}, {_EXTRAS}>"
_RELATIONSHIP = (
    "STRUCT<name: STRING, `from`: STRING, `to`: STRING, from_columns: ARRAY<STRING>, "
    f"to_columns: ARRAY<STRING>, {_EXTRAS}>"
)
_MODEL = (
    f"STRUCT<name: STRING, description: STRING, datasets: ARRAY<{_DATASET}>, "
    f"metrics: ARRAY<{_METRIC}>, relationships: ARRAY<{_RELATIONSHIP}>, {_EXTRAS}>"
)
DOCUMENT = f"version STRING, semantic_model ARRAY<{_MODEL}>"


def model_rows(parsed: DataFrame) -> DataFrame:
    """One row per semantic model: ``file_path``, ``version``, ``m``."""
    doc = parsed.filter("error IS NULL").select("file_path", F.from_json("json", DOCUMENT).alias("doc"))
    return doc.select(
        "file_path", F.col("doc.version").alias("version"), F.explode("doc.semantic_model").alias("m")
    )


def _present(context: Column) -> Column:
    return F.when(~F.is_variant_null(context), context)


def _extras(at: str) -> list[Column]:
    """Synonyms out of an object context, the context itself as JSON text, extensions."""
    context = _present(F.col(f"{at}.ai_context"))
    return [
        F.coalesce(
            F.try_variant_get(context, "$.synonyms", "array<string>"), F.array().cast("array<string>")
        ).alias("synonyms"),
        F.to_json(context).alias("ai_context"),
        F.col(f"{at}.custom_extensions").alias("custom_extensions"),
    ]


def _list(col: str, element: str = "string") -> Column:
    return F.coalesce(F.col(col), F.array().cast(f"array<{element}>"))


_DIALECTS = "struct<dialect:string,expression:string>"


def models(rows: DataFrame) -> DataFrame:
    return specs.OSI_MODEL.conform(
        rows.select(
            F.col("m.name").alias("name"),
            "version",
            text_or_blank(F.col("m.description")).alias("description"),
            *_extras("m"),
        )
    )


def datasets(rows: DataFrame) -> DataFrame:
    d = rows.select(F.col("m.name").alias("model_name"), F.explode("m.datasets").alias("d"))
    return specs.OSI_DATASET.conform(
        d.select(
            "model_name",
            "d.name",
            "d.source",
            _list("d.primary_key").alias("primary_key"),
            _list("d.unique_keys", "array<string>").alias("unique_keys"),
            text_or_blank(F.col("d.description")).alias("description"),
            *_extras("d"),
        )
    )


def fields(rows: DataFrame, *, with_model: bool = False) -> DataFrame:
    """``with_model`` adds ``model_name``, which tells equal dataset names in two models apart."""
    d = rows.select(F.col("m.name").alias("model_name"), F.explode("m.datasets").alias("d"))
    f = d.select("model_name", F.col("d.name").alias("dataset_name"), F.explode("d.fields").alias("f"))
    columns = f.select(
        "model_name",
        "dataset_name",
        "f.name",
        "f.label",
        text_or_blank(F.col("f.description")).alias("description"),
        F.coalesce(F.col("f.dimension.is_time"), F.lit(False)).alias("is_time_dimension"),
        _list("f.expression.dialects", _DIALECTS).alias("expressions"),
        *_extras("f"),
    )
    return columns if with_model else specs.OSI_FIELD.conform(columns)


def metrics(rows: DataFrame) -> DataFrame:
    x = rows.select(F.col("m.name").alias("model_name"), F.explode("m.metrics").alias("x"))
    return specs.OSI_METRIC.conform(
        x.select(
            "model_name",
            "x.name",
            text_or_blank(F.col("x.description")).alias("description"),
            _list("x.expression.dialects", _DIALECTS).alias("expressions"),
            *_extras("x"),
        )
    )


def relationships(rows: DataFrame) -> DataFrame:
    r = rows.select(F.col("m.name").alias("model_name"), F.explode("m.relationships").alias("r"))
    return specs.OSI_RELATIONSHIP.conform(
        r.select(
            "model_name",
            "r.name",
            F.col("r.from").alias("from_dataset"),
            F.col("r.to").alias("to_dataset"),
            "r.from_columns",
            "r.to_columns",
            *_extras("r"),
        )
    )


def family(rows: DataFrame) -> dict[str, DataFrame]:
    return {
        "osi_model": models(rows),
        "osi_dataset": datasets(rows),
        "osi_field": fields(rows),
        "osi_metric": metrics(rows),
        "osi_relationship": relationships(rows),
    }
