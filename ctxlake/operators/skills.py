"""Markdown skills → root rows and skill_use rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import specs
from ..functions.text import variant_kind, without_suffix
from ..sources.yamldoc import parse_yaml

# A fence is a line that is only ``---``; the first one must be the first line.
_OPENED = r"\A[^\S\n]*---[^\S\n]*(?:\n|\z)"
_FENCE = r"(?md)^[^\S\n]*---[^\S\n]*(?:\n|\z)"


def skill_key():
    return F.concat(F.lit("skill/"), without_suffix(F.col("file_path"), ".md"))


def root_rows(docs: DataFrame, provider: str) -> DataFrame:
    """The whole file, unchanged, under ``skill/<relative path without suffix>``."""
    return specs.ROOT.conform(docs.select(F.lit(provider).alias("provider"), skill_key().alias("key"), "content"))


def declarations(docs: DataFrame) -> DataFrame:
    """Skills with frontmatter: ``(skill_key, warning, uses)``.

    Any fault drops all uses of that skill and gives one warning.
    """
    opened = docs.filter(F.col("content").rlike(_OPENED)).select(
        "file_path",
        # Before, between and after the first two fences; the text is scanned no further.
        F.try_element_at(F.split("content", _FENCE, 3), F.lit(2)).alias("front"),
        (F.size(F.split("content", _FENCE, 3)) == 3).alias("closed"),
    ).select("file_path", F.when(F.col("closed"), F.col("front")).alias("content"))
    parsed = parse_yaml(opened).select(
        skill_key().alias("skill_key"),
        F.col("content").isNull().alias("unclosed"),
        "error",
        F.try_parse_json("json").alias("front"),
    )
    uses = F.try_variant_get("front", "$.uses", "variant")
    front_kind, uses_kind = variant_kind(F.col("front")), variant_kind(F.col("uses"))
    frame = parsed.withColumn("uses", F.when(front_kind == "object", uses))

    def listed(name):
        return F.try_variant_get("uses", f"$.{name}", "array<variant>")

    def misshapen(name):
        kind = variant_kind(F.try_variant_get("uses", f"$.{name}", "variant"))
        texts = F.forall(
            listed(name),
            lambda v: (variant_kind(v) == "text") & (F.try_variant_get(v, "$", "string") != ""),
        )
        return (kind != "null") & ((kind != "list") | ~F.coalesce(texts, F.lit(False)))

    def texts(name):
        return F.coalesce(
            F.try_variant_get("uses", f"$.{name}", "array<string>"), F.array().cast("array<string>")
        )

    extra = F.size(
        F.array_except(
            F.map_keys(F.try_variant_get("uses", "$", "map<string,variant>")),
            F.array(F.lit("schemas"), F.lit("tables")),
        )
    )
    declares = (front_kind == "object") & (uses_kind == "object")
    warning = (
        F.when(F.col("unclosed"), F.lit("frontmatter is not closed"))
        .when(F.col("error").isNotNull(), F.concat(F.lit("frontmatter is not valid YAML: "), "error"))
        .when(~front_kind.isin("null", "object"), F.lit("frontmatter is not a mapping"))
        .when((front_kind == "object") & ~uses_kind.isin("null", "object"), F.lit("uses is not a mapping"))
        .when(declares & misshapen("schemas"), F.lit("uses.schemas is not a list of strings"))
        .when(declares & misshapen("tables"), F.lit("uses.tables is not a list of strings"))
        .when(
            declares & F.exists(texts("tables"), lambda t: ~F.contains(t, F.lit("."))),
            F.lit("uses.tables has an entry without schema"),
        )
        .when(declares & (extra > 0), F.lit("uses has fields besides schemas and tables"))
    )

    def rows(name, kind):
        return F.transform(
            texts(name), lambda v: F.struct(F.lit(kind).alias("use_kind"), v.alias("object_ref"))
        )

    found = F.array_distinct(F.concat(rows("schemas", "schema"), rows("tables", "table")))
    none = F.array().cast("array<struct<use_kind:string,object_ref:string>>")
    return frame.select("skill_key", warning.alias("warning"), found.alias("found")).select(
        "skill_key",
        "warning",
        F.when(F.col("warning").isNull(), F.col("found")).otherwise(none).alias("uses"),
    )


def use_rows(declared: DataFrame, provider: str) -> DataFrame:
    return specs.SKILL_USE.conform(
        declared.select(F.lit(provider).alias("provider"), "skill_key", F.inline("uses"))
    )


def warnings(declared: DataFrame) -> DataFrame:
    return declared.filter("warning IS NOT NULL").select("skill_key", "warning")
