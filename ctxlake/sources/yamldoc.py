"""YAML text → JSON text, one row per document.

Only the YAML reading itself is Python. Everything after it (typing, exploding,
defaults, checks) works on the JSON text with built-in functions.
"""

from __future__ import annotations

import json
import re
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F, types as T

from ..runtime import spread
from .arrow import flat_map_documents

_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("json", T.StringType()),
        T.StructField("key_paths", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("error", T.StringType()),
    ]
)
DATE_TAG = "$date"

# Characters that YAML does not read, or not as JSON does: unprintable ones, further line breaks, tabs.
_NOT_YAML = re.compile(r"[^\n -~\xa0-\u2027\u202a-\ud7ff\ue000-\ufefe\uff00-\ufffd\U00010000-\U0010ffff]")
_SURROGATE = re.compile(r"\\u[dD][89a-fA-F]")
_LATE_COLON = re.compile(r"\n\s*:")
_FAR = " " * 99
_YAML_FLOAT = re.compile(r"-?[0-9]+\.[0-9]*(?:[eE][-+][0-9]+)?")
_KEY_CHARS = 100  # YAML takes keys of up to 1,024 characters; an escape is up to 6 for one


def _json_float(text: str):
    """Of the numbers of JSON, YAML 1.1 takes those with a dot and a sign in the exponent; others are strings."""
    return float(text) if _YAML_FLOAT.fullmatch(text) else text


def _json_object(pairs: list[tuple]) -> dict:
    if any(len(key) > _KEY_CHARS for key, _ in pairs):
        raise ValueError("a long key")
    return dict(pairs)


def _json_constant(text: str):
    raise ValueError(text)


def _yaml_reads_alike(text: str) -> bool:
    if not text.isprintable() and (_NOT_YAML.search(text) or _LATE_COLON.search(text)):
        return False
    return not (_FAR in text or "\\/" in text or _SURROGATE.search(text))


def read_json(text: str):
    """What YAML reads from text that is JSON; ValueError where it is not, or where YAML may differ.

    JSON written in the plain way is YAML, and reading it as JSON takes a small part of the time.
    """
    if not text.startswith(("{", "[")) or not _yaml_reads_alike(text):
        raise ValueError("not plain JSON")
    return json.loads(
        text, parse_float=_json_float, parse_constant=_json_constant, object_pairs_hook=_json_object
    )


def _plain(value, tag_dates: bool):
    if isinstance(value, dict):
        return {str(k): _plain(v, tag_dates) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v, tag_dates) for v in value]
    if isinstance(value, (date, datetime)):
        return {DATE_TAG: value.isoformat()} if tag_dates else value.isoformat()
    if value is None or isinstance(value, (str, bool, int, float)):
        return value
    return str(value)


def _mapping_paths(tree, prefix=()):
    if isinstance(tree, dict):
        for key, below in tree.items():
            here = (*prefix, str(key))
            yield list(here)
            yield from _mapping_paths(below, here)


def parse_yaml(docs: DataFrame, *, tree: str | None = None, tag_dates: bool = False) -> DataFrame:
    """``(file_path, content, json, key_paths, error)``.

    ``tree`` names a top-level mapping whose nested key paths are listed in
    ``key_paths``. ``tag_dates`` renders YAML dates as ``{"$date": text}`` so that
    checks can tell them from strings. Unreadable text gives ``error``.
    """

    def parse(path, content):
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
        try:
            try:
                doc = _plain(read_json(content or ""), tag_dates)
            except (ValueError, RecursionError):
                doc = _plain(yaml.load(content or "", Loader=loader), tag_dates)
            text = json.dumps(doc, ensure_ascii=False, allow_nan=False)
        except (yaml.YAMLError, ValueError, RecursionError) as error:
            yield (path, content, None, None, str(error))
            return
        paths = list(_mapping_paths(doc.get(tree))) if tree and isinstance(doc, dict) else None
        yield (path, content, text, paths, None)

    return flat_map_documents(spread(docs), parse, _SCHEMA)


def mappings(parsed: DataFrame) -> DataFrame:
    """Documents that are mappings; an empty document counts as an empty mapping."""
    text = F.when(F.col("json").isin("null", "", "[]", '""', "false", "0"), F.lit("{}")).otherwise(F.col("json"))
    return parsed.withColumn("json", text).filter("error IS NULL AND startswith(json, '{')")


def rejects(parsed: DataFrame) -> DataFrame:
    """Documents that could not be used: unreadable, or not a mapping."""
    empty = F.col("json").isin("null", "", "[]", '""', "false", "0")
    message = F.when(F.col("error").isNotNull(), F.col("error")).when(
        ~(F.col("json").startswith("{") | empty), F.lit("document is not a mapping")
    )
    return parsed.select("file_path", message.alias("message")).filter("message IS NOT NULL")
