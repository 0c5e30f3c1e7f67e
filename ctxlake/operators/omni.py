"""Omni view and topic documents → the five omni tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import specs
from ..functions.text import file_name, parent_folder, text_or_blank, without_suffix, yes_or_true
from ..sources.yamldoc import mappings

VIEW_SUFFIX = ".view.yaml"
TOPIC_SUFFIX = ".topic.yaml"
# Fixed pattern of the naming comment.
NAMING_COMMENT = r"#\s*Reference this view as\s+(\S+)"

# Field bodies stay JSON text here: an entry may be a mapping or anything else.
_VIEW = (
    "`schema` STRING, table_name STRING, label STRING, description STRING, "
    "dimensions STRING, measures STRING"
)
_FIELD = (
    "label STRING, `sql` STRING, format STRING, description STRING, primary_key STRING, aggregate_type STRING"
)
_TOPIC = (
    "base_view STRING, label STRING, group_label STRING, description STRING, ai_context STRING"
)


def view_documents(parsed: DataFrame) -> DataFrame:
    """Readable view documents with their name: from the naming comment, else from the path."""
    head = F.array_join(F.slice(F.split("content", r"\R"), 1, 5), "\n")
    stem = without_suffix(file_name(F.col("file_path")), VIEW_SUFFIX)
    name = F.coalesce(
        F.nullif(F.regexp_extract(head, NAMING_COMMENT, 1), F.lit("")),
        F.concat(parent_folder(F.col("file_path")), F.lit("__"), stem),
        stem,
    )
    return mappings(parsed).select(
        name.alias("view_name"), "file_path", F.from_json("json", _VIEW).alias("doc")
    )


def views(docs: DataFrame) -> DataFrame:
    return specs.OMNI_VIEW.conform(
        docs.select(
            "view_name", "doc.schema", "doc.table_name", "doc.label", "doc.description", "file_path"
        )
    )


def _fields(docs: DataFrame, section: str, name: str) -> DataFrame:
    entries = F.from_json(F.col(f"doc.{section}"), "MAP<STRING, STRING>")
    body = F.when(F.col("entry").startswith("{"), F.from_json("entry", _FIELD))
    return docs.select("view_name", F.explode(entries).alias(name, "entry")).select(
        "view_name", name, body.alias("f")
    )


def dimensions(docs: DataFrame) -> DataFrame:
    return specs.OMNI_DIMENSION.conform(
        _fields(docs, "dimensions", "field_name").select(
            "view_name",
            "field_name",
            "f.label",
            "f.sql",
            "f.format",
            "f.description",
            yes_or_true(F.col("f.primary_key")).alias("primary_key"),
        )
    )


def measures(docs: DataFrame) -> DataFrame:
    return specs.OMNI_MEASURE.conform(
        _fields(docs, "measures", "measure_name").select(
            "view_name", "measure_name", "f.label", "f.aggregate_type", "f.sql", "f.description"
        )
    )


def topic_documents(parsed: DataFrame) -> DataFrame:
    """Parse topics with ``parse_yaml(..., tree="joins")`` so ``key_paths`` lists the join tree."""
    return mappings(parsed).select(
        without_suffix(file_name(F.col("file_path")), TOPIC_SUFFIX).alias("topic_name"),
        "file_path",
        "key_paths",
        F.from_json("json", _TOPIC).alias("doc"),
    )


def topics(docs: DataFrame) -> DataFrame:
    return specs.OMNI_TOPIC.conform(
        docs.select(
            "topic_name",
            text_or_blank(F.col("doc.base_view")).alias("base_view"),
            "doc.label",
            "doc.group_label",
            "doc.description",
            "doc.ai_context",
            "file_path",
        )
    )


def topic_joins(docs: DataFrame) -> DataFrame:
    """Join tree → edges. The parent is the enclosing view, at the top the base view.

    An edge can repeat only within one document, so it is dropped there.
    """
    base = text_or_blank(F.col("doc.base_view"))
    edges = F.array_distinct(
        F.transform(
            "key_paths",
            lambda p: F.struct(
                F.coalesce(F.try_element_at(p, F.when(F.size(p) > 1, F.lit(-2))), base).alias("from_view"),
                F.element_at(p, -1).alias("to_view"),
            ),
        )
    )
    return specs.OMNI_TOPIC_JOIN.conform(
        docs.select("topic_name", F.inline(edges))
    )


def family(parsed_views: DataFrame, parsed_topics: DataFrame) -> dict[str, DataFrame]:
    view_docs, topic_docs = view_documents(parsed_views), topic_documents(parsed_topics)
    return {
        "omni_view": views(view_docs),
        "omni_dimension": dimensions(view_docs),
        "omni_measure": measures(view_docs),
        "omni_topic": topics(topic_docs),
        "omni_topic_join": topic_joins(topic_docs),
    }
