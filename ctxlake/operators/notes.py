"""Object notes → notes_on_schemata, notes_on_tables, notes_on_columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import specs
from ..sources.yamldoc import mappings, rejects
from .contract import Field, Kind, document_violations, timestamp_text

_TEXT = Field("text", nullable=True)
_MUST = Field("text", required=True, filled=True)
_SCORE = Field("score", nullable=True)
_STAMP = Field("timestamp", nullable=True)
_COMMON = {
    "note_id": _MUST,
    "kind": _MUST,
    "tags": Field("list", nullable=True, items=Field("text", filled=True)),
    "title": _TEXT,
    "content": _MUST,
    "author": _TEXT,
    "source": _TEXT,
    "confidence": _SCORE,
    "importance": _SCORE,
    "created_at": _STAMP,
    "updated_at": _STAMP,
}
SECTIONS = {
    "schema_notes": specs.NOTES_ON_SCHEMATA,
    "table_notes": specs.NOTES_ON_TABLES,
    "column_notes": specs.NOTES_ON_COLUMNS,
}
_PLACE = {"table_catalog": _TEXT, "table_schema": _MUST, "table_name": _MUST}
NOTES_CONTRACT = {
    "file": Kind({s: Field("list", items=Field("object", kind=s)) for s in SECTIONS}),
    "schema_notes": Kind({"schema_name": _MUST, **_COMMON}),
    "table_notes": Kind({**_PLACE, **_COMMON}),
    "column_notes": Kind({**_PLACE, "column_name": _MUST, **_COMMON}),
}


def note_rows(parsed: DataFrame) -> DataFrame:
    """One row per note of every section: ``file_path``, ``section``, ``idx``, ``note``.

    Parse with ``parse_yaml(..., tag_dates=True)``.
    """
    doc = mappings(parsed).select("file_path", F.try_parse_json("json").alias("doc"))
    sections = F.array(
        *[
            F.struct(
                F.lit(s).alias("section"),
                F.try_variant_get("doc", f"$.{s}", "array<variant>").alias("notes"),
            )
            for s in SECTIONS
        ]
    )
    listed = doc.select("file_path", F.inline(sections))
    return listed.select("file_path", "section", F.posexplode("notes").alias("idx", "note"))


def contract_violations(parsed: DataFrame) -> DataFrame:
    """Violations of readability, top-level shape and single notes: ``(file_path, path, rule, message)``."""
    unread = rejects(parsed).select("file_path", F.lit("").alias("path"), F.lit("yaml").alias("rule"), "message")
    broken = document_violations(
        parsed.sparkSession, mappings(parsed), F.try_parse_json("json"), NOTES_CONTRACT, "file"
    )
    return broken.unionByName(unread)


def duplicate_ids(parsed: DataFrame) -> DataFrame:
    """Ids used by more than one note of any section: ``(note_id, uses)``."""
    ids = note_rows(parsed).select(F.try_variant_get("note", "$.note_id", "string").alias("note_id"))
    return (
        ids.filter("note_id IS NOT NULL")
        .groupBy("note_id")
        .agg(F.count(F.lit(1)).alias("uses"))
        .filter("uses > 1")
    )


def violations(parsed: DataFrame) -> DataFrame:
    repeated = duplicate_ids(parsed).select(
        F.lit(None).cast("string").alias("file_path"),
        F.col("note_id").alias("path"),
        F.lit("duplicate").alias("rule"),
        F.format_string("note_id is used %d times", F.col("uses")).alias("message"),
    )
    return contract_violations(parsed).unionByName(repeated)


def _value(name: str, kind) -> Column:
    at = F.try_variant_get("note", f"$.{name}", "variant")
    if name in ("created_at", "updated_at"):
        return F.try_to_timestamp(timestamp_text(at)).alias(name)
    return F.try_variant_get("note", f"$.{name}", kind.simpleString()).alias(name)


def section_notes(rows: DataFrame, section: str) -> DataFrame:
    spec = SECTIONS[section]
    picked = rows.filter(F.col("section") == section)
    return spec.conform(picked.select(*[_value(f.name, f.dataType) for f in spec.schema.fields]))


def valid_rows(parsed: DataFrame) -> DataFrame:
    """Notes without violations of their own (quarantine mode)."""
    note_path = F.regexp_extract("path", r"^/(\w+/\d+)", 1)
    broken = contract_violations(parsed).select("file_path", note_path.alias("at"))
    rows = note_rows(parsed).withColumn("at", F.concat("section", F.lit("/"), F.col("idx").cast("string")))
    return rows.join(broken, ["file_path", "at"], "left_anti").drop("at")


def family(rows: DataFrame) -> dict[str, DataFrame]:
    return {spec.name: section_notes(rows, section) for section, spec in SECTIONS.items()}
