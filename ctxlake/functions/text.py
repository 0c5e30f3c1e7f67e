"""Scalar helpers over strings, JSON text and VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# JSON texts that count as "no value" when picking the first filled one.
EMPTY_JSON = ("{}", "[]", '""', "", "0", "0.0", "false", "null")


def text_or_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def first_filled_json(*cols: Column) -> Column:
    """The first JSON text that is neither null nor empty, else ``{}``."""
    filled = [F.when(~F.trim(c).isin(*EMPTY_JSON), c) for c in cols]
    return F.coalesce(*filled, F.lit("{}"))


def prefix_or(col: Column, sep: str, fallback: str) -> Column:
    """Text before the first ``sep``; ``fallback`` when ``sep`` does not occur."""
    return F.when(F.contains(col, F.lit(sep)), F.substring_index(col, sep, 1)).otherwise(
        F.when(col.isNotNull(), F.lit(fallback))
    )


def yes_or_true(col: Column) -> Column:
    return F.coalesce(F.lower(col).isin("yes", "true"), F.lit(False))


def unix_newlines(col: Column) -> Column:
    return F.regexp_replace(col, r"\r\n?", "\n")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_folder(path: Column) -> Column:
    """Name of the directory holding the file; null at the top level."""
    return F.when(
        F.contains(path, F.lit("/")), F.element_at(F.split(path, "/"), -2)
    )


def without_suffix(col: Column, suffix: str) -> Column:
    return F.when(col.endswith(suffix), F.left(col, F.length(col) - len(suffix))).otherwise(col)


def search_text(*cols: Column) -> Column:
    """Lowercased concatenation used by keyword search."""
    return F.lower(F.concat_ws(" ", *[text_or_blank(c) for c in cols]))


def strip_comments(col: Column) -> Column:
    """Remove ``#`` comments that are not inside quotes; backslash escapes a quote."""
    quoted = (
        r'"(?:[^"\\]++|\\.)*+(?:"|\z)'
        r"|'(?:[^'\\]++|\\.)*+(?:'|\z)"
    )
    return F.regexp_replace(col, rf"(?s)({quoted})|#[^\n]*", "$1")


def plain_lookml_sql(col: Column) -> Column:
    """Liquid conditionals become their else branch; ``${TABLE}.col`` becomes ``col``."""
    no_liquid = F.regexp_replace(
        col, r"(?s)\{%-?\s*if\b.*?%\}.*?\{%-?\s*else\s*-?%\}(.*?)\{%-?\s*endif\s*-?%\}", "$1"
    )
    return F.trim(F.regexp_replace(no_liquid, r"\$\{TABLE\}\s*\.\s*", ""))


def plain_identifier(col: Column) -> Column:
    """Inner identifier of a quoted column reference such as ``"AMOUNT"``."""
    return F.regexp_replace(F.trim(col), r"""^['"]*"([^"]+)"['"]*$""", "$1")


def currency(col: Column) -> Column:
    return F.concat(
        F.when(col < 0, F.lit("-$")).otherwise(F.lit("$")), F.format_number(F.abs(F.round(col, 0)), 0)
    )


def percent(ratio: Column) -> Column:
    return F.concat(F.format_number(F.round(ratio * 100, 1), 1), F.lit("%"))


def variant_kind(value: Column) -> Column:
    """``text number bool list object null`` (``null`` also for a missing value)."""
    shape = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | F.is_variant_null(value), F.lit("null"))
        .when(shape == "STRING", F.lit("text"))
        .when(shape == "BOOLEAN", F.lit("bool"))
        .when(shape.startswith("ARRAY"), F.lit("list"))
        .when(shape.startswith("OBJECT"), F.lit("object"))
        .otherwise(F.lit("number"))
    )
