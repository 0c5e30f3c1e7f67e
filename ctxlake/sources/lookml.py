"""LookML text → one row per view, explore, dimension, dimension_group and measure.

A single pass over the statements of a file with a stack of open blocks. Each
row carries the properties written directly in that block, so nested blocks
never leak into their parent.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.text import strip_comments
from ..runtime import spread
from .arrow import flat_map_documents

BLOCKS = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("view_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("props", T.MapType(T.StringType(), T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)
TOP = ("view", "explore")
FIELDS = ("dimension", "dimension_group", "measure")

# Possessive throughout: no part can take what the next one needs, so nothing is tried twice.
_QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|\'[^\'\\]*+(?:\\.[^\'\\]*+)*+\''
_NEXT = re.compile(
    r"(?=[\w+.{}\"'])(?:"
    r"(?P<open>(?!sql(?:_table_name)?\s*+:)(?:(?P<kind>[A-Za-z_]\w*+)\s*+:\s*+)?+(?P<name>[+\w.]*+)\s*+\{)"
    r"|(?P<close>\})"
    r"|(?P<key>[A-Za-z_]\w*+)\s*+:[ \t]*+"
    rf"|(?:{_QUOTED}))",
    re.S,
)
_NAME = re.compile(r"[A-Za-z_][\w.]*\Z")
_TEXT = re.compile(_QUOTED, re.S)
_LIST_END = re.compile(rf"(?:{_QUOTED}|[^\]\"']++)*+\]", re.S)
_SQL_END = re.compile(r"[{}]|;;")
# The end can only stand before white space, a brace or a semicolon; other characters are passed in runs.
_BARE = re.compile(
    r"(?:[^\s{};$]++|\$\{[^}]*\}|[^\n{}])*?(?=[\s};]|\Z)(?=\s+[A-Za-z_]\w*\s*:(?!:)|\s*\n|\s*\}|;;|\s*\Z)"
)


def _unquoted(value: str) -> str:
    value = value.strip()
    if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"":
        return value[1:-1]
    return value


def _sql_value(text: str, at: int) -> tuple[str, int]:
    """SQL runs to ``;;``, or to the end of its block when there is none."""
    depth, end, after = 0, len(text), len(text)
    for token in _SQL_END.finditer(text, at):
        mark = token.group()
        if mark == ";;" or (mark == "}" and depth == 0):
            end, after = token.start(), token.end() if mark == ";;" else token.start()
            break
        depth += 1 if mark == "{" else -1
    value = text[at:end].strip()
    return "\n".join(line.strip() for line in value.split("\n")) if "\n" in value else value, after


def _value(text: str, key: str, at: int) -> tuple[str, int]:
    if key == "sql":
        return _sql_value(text, at)
    line_end = text.find("\n", at)
    line_end = line_end if line_end >= 0 else len(text)
    if key == "sql_table_name":
        line = text[at:line_end]
        if ";;" in line or not line.strip():
            return _sql_value(text, at)
    if match := _TEXT.match(text, at):
        return match.group()[1:-1], match.end()
    if text.startswith("[", at) and (match := _LIST_END.match(text, at + 1)):
        return _unquoted(match.group()[:-1]), match.end()
    match = _BARE.match(text, at)
    return (_unquoted(match.group()), match.end()) if match else (text[at:line_end].strip(), line_end)


def _add_filter(around: dict, block: dict) -> None:
    """The block form ``filters: { field: … value: … }``, of which there may be several, as the list form.

    A block without field or value stays in a form that no translation accepts.
    """
    field, value = block.get("field"), block.get("value")
    text = f'{field}: "{value}"' if field and value is not None and '"' not in value else "?"
    around["filters"] = ", ".join(filter(None, (around.get("filters"), text)))


def lookml_rows(path: str, text: str):
    rows, stack, at = [], [], 0
    while match := _NEXT.search(text, at):
        at, token = match.end(), match.lastgroup
        if token == "key":
            key = match.group("key")
            value, at = _value(text, key, at)
            if stack:
                stack[-1][2][key] = value
        elif token == "open":
            kind, name = match.group("kind", "name")
            known = kind in TOP + FIELDS and _NAME.match(name)
            stack.append((kind if known else None, name, {}, kind))
        elif token == "close" and stack:
            kind, name, props, word = stack.pop()
            if word == "filters" and stack:
                _add_filter(stack[-1][2], props)
            if not kind:
                continue
            around = [b for b in stack if b[0]]
            if kind in TOP and not around:
                rows.append((path, kind, None, name, props, None))
            elif kind in FIELDS and len(around) == 1 and around[0][0] == "view":
                rows.append((path, kind, around[0][1], name, props, None))
    if any(block[0] for block in stack):
        return [(path, None, None, None, None, "a block has no closing brace")]
    return rows


def parse_lookml(docs: DataFrame) -> DataFrame:
    """``(file_path, kind, view_name, name, props, error)``; a broken file gives one error row."""
    clean = spread(docs).select("file_path", strip_comments(F.col("content")).alias("content"))
    return flat_map_documents(clean, lookml_rows, BLOCKS)
