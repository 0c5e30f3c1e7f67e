"""Table contracts: ordered columns, types, required columns and keys.

Spark has no primary keys and does not enforce ``nullable=False`` on write, so
both live here; ``operators.checks`` turns them into violation DataFrames and
``operators.store`` uses the keys for upsert, delete and reconcile.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

_STRING = T.StringType()
SOURCE_FILE = "source_file"
_TYPES = {
    "text": _STRING,
    "bool": T.BooleanType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "list": T.ArrayType(_STRING),
    "keylists": T.ArrayType(T.ArrayType(_STRING)),
    "dialects": T.ArrayType(
        T.StructType([T.StructField("dialect", _STRING), T.StructField("expression", _STRING)])
    ),
    "extensions": T.ArrayType(
        T.StructType([T.StructField("vendor_name", _STRING), T.StructField("data", _STRING)])
    ),
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    bucket_by: tuple[str, ...] = ()
    buckets: int = 1

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def value_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys]

    def with_buckets(self, buckets: int) -> TableSpec:
        """The same table spread over hash buckets of ``bucket_by``.

        A change then rewrites only the buckets its keys fall into. Choose the number
        once per table, so that a bucket holds a few files of full size.
        """
        return replace(self, buckets=buckets)

    def by_file(self) -> TableSpec:
        """What each file gives to this table: the same rows under the file they came from."""
        schema = T.StructType([T.StructField(SOURCE_FILE, _STRING, nullable=False), *self.schema.fields])
        return replace(self, name=f"{self.name}_by_file", schema=schema, keys=(SOURCE_FILE, *self.keys))

    @property
    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def conform(self, df: DataFrame) -> DataFrame:
        """The table's columns by name, in order, in the declared types."""
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])


def _table(name: str, keys: str, columns: str, bucket_by: str = "") -> TableSpec:
    """``columns`` is ``name[!][:type] ...``; ``!`` marks a required column."""
    fields = []
    for item in columns.split():
        label, _, kind = item.partition(":")
        fields.append(
            T.StructField(label.rstrip("!"), _TYPES[kind or "text"], nullable=not label.endswith("!"))
        )
    return TableSpec(name, T.StructType(fields), tuple(keys.split()), tuple((bucket_by or keys).split()))


# Columns, keys and required columns below are fixed values: the published contract of the tables.
_NOTE_TAIL = (
    "kind! tags:list title content! author source "
    "confidence:double importance:double created_at:timestamp updated_at:timestamp"
)

ROOT = _table("root", "provider key", "provider! key! content!")
SKILL_USE = _table(
    "skill_use",
    "provider skill_key use_kind object_ref",
    "provider! skill_key! use_kind! object_ref!",
    bucket_by="provider skill_key",
)
DBT_MODEL = _table(
    "dbt_model",
    "unique_id",
    "unique_id! name! database_name schema_name materialization description file_path tags:list meta",
)
DBT_COLUMN = _table(
    "dbt_column", "model_id column_name", "model_id! column_name! data_type description"
)
DBT_DEPENDENCY = _table(
    "dbt_dependency",
    "upstream_id downstream_id",
    "upstream_id! downstream_id! upstream_type downstream_type",
)
LOOKML_VIEW = _table(
    "lookml_view", "name", "name! sql_table_name label description ai_context file_path"
)
LOOKML_DIMENSION = _table(
    "lookml_dimension",
    "view_name field_name",
    "view_name! field_name! field_kind! type sql description ai_context primary_key:bool",
)
LOOKML_MEASURE = _table(
    "lookml_measure",
    "view_name measure_name",
    "view_name! measure_name! type sql description ai_context filters",
)
LOOKML_EXPLORE = _table(
    "lookml_explore", "name", "name! from_view label description ai_context file_path"
)
OMNI_VIEW = _table(
    "omni_view", "view_name", "view_name! schema table_name label description file_path"
)
OMNI_DIMENSION = _table(
    "omni_dimension",
    "view_name field_name",
    "view_name! field_name! label sql format description primary_key:bool",
)
OMNI_MEASURE = _table(
    "omni_measure",
    "view_name measure_name",
    "view_name! measure_name! label aggregate_type sql description",
)
OMNI_TOPIC = _table(
    "omni_topic",
    "topic_name",
    "topic_name! base_view label group_label description ai_context file_path",
)
OMNI_TOPIC_JOIN = _table(
    "omni_topic_join", "topic_name from_view to_view", "topic_name! from_view! to_view!"
)
OSI_MODEL = _table(
    "osi_model", "name", "name! version description synonyms:list ai_context custom_extensions:extensions"
)
OSI_DATASET = _table(
    "osi_dataset",
    "model_name name",
    "model_name! name! source! primary_key:list unique_keys:keylists description synonyms:list "
    "ai_context custom_extensions:extensions",
)
OSI_FIELD = _table(
    "osi_field",
    "dataset_name name",
    "dataset_name! name! label description is_time_dimension:bool expressions:dialects "
    "synonyms:list ai_context custom_extensions:extensions",
)
OSI_METRIC = _table(
    "osi_metric",
    "model_name name",
    "model_name! name! description expressions:dialects synonyms:list ai_context "
    "custom_extensions:extensions",
)
OSI_RELATIONSHIP = _table(
    "osi_relationship",
    "model_name name",
    "model_name! name! from_dataset! to_dataset! from_columns!:list to_columns!:list synonyms:list "
    "ai_context custom_extensions:extensions",
)
NOTES_ON_SCHEMATA = _table(
    "notes_on_schemata", "note_id", "note_id! schema_name! " + _NOTE_TAIL
)
NOTES_ON_TABLES = _table(
    "notes_on_tables", "note_id", "note_id! table_catalog table_schema! table_name! " + _NOTE_TAIL
)
NOTES_ON_COLUMNS = _table(
    "notes_on_columns",
    "note_id",
    "note_id! table_catalog table_schema! table_name! column_name! " + _NOTE_TAIL,
)

# Not a published table: what a refresh knows of the files it has taken in.
FILE_LEDGER = TableSpec(
    "file_ledger",
    T.StructType(
        [
            T.StructField("file_path", _STRING, nullable=False),
            T.StructField("length", T.LongType(), nullable=False),
            T.StructField("modified", T.TimestampType(), nullable=False),
            T.StructField("error", _STRING),
        ]
    ),
    ("file_path",),
    ("file_path",),
)

FAMILIES: dict[str, tuple[TableSpec, ...]] = {
    "dbt": (DBT_MODEL, DBT_COLUMN, DBT_DEPENDENCY),
    "lookml": (LOOKML_VIEW, LOOKML_DIMENSION, LOOKML_MEASURE, LOOKML_EXPLORE),
    "omni": (OMNI_VIEW, OMNI_DIMENSION, OMNI_MEASURE, OMNI_TOPIC, OMNI_TOPIC_JOIN),
    "osi": (OSI_MODEL, OSI_DATASET, OSI_FIELD, OSI_METRIC, OSI_RELATIONSHIP),
    "skills": (SKILL_USE,),
    "notes_on": (NOTES_ON_SCHEMATA, NOTES_ON_TABLES, NOTES_ON_COLUMNS),
}
ALL_TABLES: dict[str, TableSpec] = {
    t.name: t for t in (ROOT, *[t for family in FAMILIES.values() for t in family])
}
