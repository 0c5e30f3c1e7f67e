"""Measures of catalog views as SQL, with filters on dimensions, and their evaluation.

A filter value is read by the type of the dimension it names and becomes a condition on that dimension's SQL, so a
filter on a computed dimension means its computation. Conditions of one filter are alternatives, negated ones exclude. What is not
understood (relative dates, ranges of text, escapes) makes the measure ``unsupported``, never unfiltered.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .metrics import _FILTER, AGGREGATES, _filter_clause, expand_formulas

_NUMBER = r"-?\d+(?:\.\d+)?"
_EDGE = rf"\s*({_NUMBER}|-?inf|)\s*"
_INTERVAL = rf"(?i)^([\[(]){_EDGE},{_EDGE}([\])])$"


def _quoted(text: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")), F.lit("'"))


def _said(*parts) -> Column:
    """Concatenation in which plain strings stand for themselves."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _text_condition(field: Column, item: Column) -> Column:
    plain = item != ""
    part = lambda pattern: F.regexp_extract(item, pattern, 1)
    inner = r"^%([^%^]+)%$", r"^([^%^]+)%$", r"^%([^%^]+)$"
    return (
        F.when(F.upper(item) == "NULL", _said(field, " IS NULL"))
        .when(F.upper(item) == "EMPTY", _said("(", field, " IS NULL OR ", field, " = '')"))
        .when(item.rlike(inner[0]), _said("contains(", field, ", ", _quoted(part(inner[0])), ")"))
        .when(item.rlike(inner[1]), _said("startswith(", field, ", ", _quoted(part(inner[1])), ")"))
        .when(item.rlike(inner[2]), _said("endswith(", field, ", ", _quoted(part(inner[2])), ")"))
        .when(plain & ~item.rlike("[%^]"), _said(field, " = ", _quoted(item)))
    )


def _number_condition(field: Column, item: Column) -> Column:
    compared = rf"^(>=|<=|>|<)\s*({_NUMBER})$"
    between = rf"(?i)^({_NUMBER})\s+to\s+({_NUMBER})$"
    got = lambda pattern, k: F.regexp_extract(item, pattern, k)
    bounded = lambda k: got(_INTERVAL, k).rlike(r"\d")
    low = F.when(bounded(2), _said(field, F.when(got(_INTERVAL, 1) == "[", " >= ").otherwise(" > "), got(_INTERVAL, 2)))
    high = F.when(bounded(3), _said(field, F.when(got(_INTERVAL, 4) == "]", " <= ").otherwise(" < "), got(_INTERVAL, 3)))
    return (
        F.when(F.upper(item) == "NULL", _said(field, " IS NULL"))
        .when(item.rlike(rf"^{_NUMBER}$"), _said(field, " = ", item))
        .when(item.rlike(compared), _said(field, " ", got(compared, 1), " ", got(compared, 2)))
        .when(item.rlike(between), _said(field, " BETWEEN ", got(between, 1), " AND ", got(between, 2)))
        .when(item.rlike(_INTERVAL) & (low.isNotNull() | high.isNotNull()), _said("(", F.concat_ws(" AND ", low, high), ")"))
    )


def filter_condition(field: Column, kind: Column, value: Column) -> Column:
    """Condition on ``field`` (its SQL) of type ``kind``; null where the value is not understood."""

    def tree(items: Column, negated: Callable, condition: Callable) -> Column:
        """Alternatives in one bracket, then what is excluded; a null in either makes the whole null."""
        items = F.transform(items, lambda x: F.trim(x))
        nodes = F.transform(items, lambda x: F.struct((negated(x) != "").alias("out"), condition(F.when(negated(x) != "", F.trim(F.substr(x, F.length(negated(x)) + 1))).otherwise(x)).alias("sql")))
        wanted = F.transform(F.filter(nodes, lambda e: ~e["out"]), lambda e: e["sql"])
        without = F.transform(F.filter(nodes, lambda e: e["out"]), lambda e: _said("NOT coalesce(", e["sql"], ", false)"))
        either = F.when(F.size(wanted) > 0, _said("(", F.array_join(wanted, " OR "), ")"))
        none = F.when(F.size(without) > 0, F.array_join(without, " AND "))
        return F.when(~F.exists(nodes, lambda e: e["sql"].isNull()), F.concat_ws(" AND ", either, none))

    value, kind = F.trim(value), F.lower(kind)
    texts = tree(F.split(value, ","), lambda x: F.when(x.startswith("-"), "-").otherwise(""), lambda x: _text_condition(field, x))
    numbers = tree(
        F.split(value, r",(?![^\[(]*[\])])"), lambda x: F.regexp_extract(x, r"(?i)^(?:not\s+|<>|!=)", 0), lambda x: _number_condition(field, x)
    )
    truth = F.when(F.lower(value) == "yes", field).when(F.lower(value) == "no", _said("NOT coalesce(", field, ", false)"))
    return F.when(kind == "yesno", truth).when(kind == "number", numbers).when(F.coalesce(kind, F.lit("string")).isin("string", "zipcode"), texts)


def measure_formulas(measures: DataFrame, fields: DataFrame) -> DataFrame:
    """Aggregate SQL of every measure: ``view_name, name, status, resolved, formula``.

    ``measures(view_name, measure_name, type, sql, filters)`` and ``fields(view_name, field_name, type, sql)`` are the catalog's
    tables; Omni rows fit with their aggregate type as ``type`` and null filters. A filter may name a dimension of another view as
    ``view.field``; a name of the own view that is no dimension is taken as a column. Status: ``ok``, ``unsupported`` (kind or filter),
    ``unknown`` or ``cycle`` as of ``expand_formulas``. Only ``ok`` measures have a formula.
    """
    kind = F.lower("type")
    opened = F.create_map(*[F.lit(x) for pair in AGGREGATES.items() for x in pair])
    measures = measures.select("view_name", F.col("measure_name").alias("name"), opened[kind].alias("opened"), kind.alias("kind"), "sql", F.trim("filters").alias("filters"))
    known = fields.dropDuplicates(["view_name", "field_name"])
    pairs = F.regexp_extract_all("filters", F.lit(_FILTER), 0)
    each = measures.filter("filters <> ''").select("view_name", "name", F.regexp_replace("filters", _FILTER, "").alias("rest"), F.posexplode_outer(pairs).alias("at", "pair"))
    named = F.regexp_extract("pair", r"^([\w.]+)", 1)
    dotted = F.contains(named, F.lit("."))
    each = each.select(
        "view_name", "name", "rest", "at", "pair",
        F.when(dotted, F.regexp_replace(named, r"\.[^.]*$", "")).otherwise(F.col("view_name")).alias("of"),
        F.substring_index(named, ".", -1).alias("field"),
        F.regexp_replace(F.trim(F.regexp_extract("pair", r"^[\w.]+\s*:\s*(.*)$", 1)), r"^[\"']|[\"']$", "").alias("value"),
    )
    declared = known.select(F.col("view_name").alias("of"), F.col("field_name").alias("field"), F.coalesce("type", F.lit("string")).alias("field_type"))
    each = each.join(declared, ["of", "field"], "left")
    own = F.when(F.col("of") == F.col("view_name"), _filter_clause(F.col("pair")))
    reference = _said("${", F.col("of"), ".", F.col("field"), "}")
    clause = F.when(F.col("field_type").isNull(), own).otherwise(filter_condition(reference, F.col("field_type"), F.col("value")))
    clauses = each.select("view_name", "name", "rest", "at", clause.alias("clause")).groupBy("view_name", "name").agg(
        F.array_sort(F.collect_list(F.struct("at", "clause"))).alias("clauses"),
        (F.count_if(F.col("clause").isNull()) + F.count_if(~F.col("rest").rlike(r"^[\s,]*$"))).alias("odd"),
    )
    value = F.when(F.col("kind") == "count", F.coalesce("sql", F.lit("1"))).otherwise(F.col("sql"))
    guard = F.array_join(F.transform("clauses", lambda e: e["clause"]), " AND ")
    text = F.when(F.col("clauses").isNull(), value).when(F.col("odd") == 0, _said("CASE WHEN ", guard, " THEN ", value, " END"))
    texts = measures.join(clauses, ["view_name", "name"], "left").select("view_name", "name", "opened", text.alias("text"))
    able = F.col("opened").isNotNull() & F.col("text").isNotNull()
    expanded = expand_formulas(
        texts.filter(able).select("view_name", "name", F.col("text").alias("sql")),
        known.select("view_name", F.col("field_name").alias("name"), "sql"),
    ).select("view_name", "name", "status", "resolved")
    return texts.join(expanded, ["view_name", "name"], "left").select(
        "view_name",
        "name",
        F.coalesce("status", F.lit("unsupported")).alias("status"),
        "resolved",
        F.when(F.col("status") == "ok", F.concat("opened", "resolved", F.lit(")"))).alias("formula"),
    )


_RESULT = "view_name string, name string, status string, value double, shown string"


def evaluate_catalog(
    spark: SparkSession, formulas: DataFrame, tables: DataFrame, read: Callable[[str], DataFrame | None], views: Sequence[str] | None = None
) -> DataFrame:
    """Every measure over the table of its view: ``view_name, name, status, value, shown``.

    ``formulas`` as of ``measure_formulas``, ``tables(view_name, source)``. All measures of a source table share one aggregation over
    it. A measure is evaluated on its own table, before any join, so no sum is multiplied by one. Numbers come as ``value``,
    others as text in ``shown``. A measure whose source is not found, or whose SQL names columns its table has not, has status
    ``invalid``. The definitions (of ``views``, if given) are what the driver plans from; data stays with the executors.
    """
    asked = formulas if views is None else formulas.filter(F.col("view_name").isin(*views))
    rows = asked.join(tables.dropDuplicates(["view_name"]), "view_name", "left").select("view_name", "name", "status", "formula", "source").collect()
    by_source: dict[str, list[tuple[str, str, Column, T.DataType]]] = {}
    out, frames = [], {}
    for view, name, status, formula, source in sorted(rows, key=lambda r: (r["view_name"], r["name"])):
        if status != "ok":
            out.append((view, name, status, None, None))
            continue
        try:
            if source not in frames:
                frames[source] = read(source) if source else None
            column = F.expr(formula)
            kind = frames[source].agg(column.alias("v")).schema[0].dataType
        except (AnalysisException, AttributeError):
            out.append((view, name, "invalid", None, None))
            continue
        by_source.setdefault(source, []).append((view, name, column, kind))
    result = spark.createDataFrame(out, _RESULT)
    for source, found in by_source.items():
        wide = frames[source].agg(*[c.alias(f"m{i}") for i, (_, _, c, _) in enumerate(found)])
        cells = [
            F.struct(
                F.lit(view).alias("view_name"), F.lit(name).alias("name"), F.lit("ok").alias("status"),
                (F.col(f"m{i}").cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")).alias("value"),
                (F.lit(None).cast("string") if isinstance(kind, T.NumericType) else F.col(f"m{i}").cast("string")).alias("shown"),
            )
            for i, (view, name, _, kind) in enumerate(found)
        ]
        result = result.unionByName(wide.select(F.inline(F.array(*cells))))
    return result
