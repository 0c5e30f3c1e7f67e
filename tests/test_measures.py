"""Filters on dimensions, measure formulas and their evaluation."""

import re

import pytest
from pyspark.sql import functions as F

from ctxlake.operators.store import change_counts
from ctxlake.plans import measures, metrics
from ctxlake.specs import DBT_MODEL, NOTES_ON_SCHEMATA


def text_keeps(value, x):
    """The meaning of a text filter, item by item."""
    wanted, without = [], []
    for item in (i.strip() for i in value.split(",")):
        out, body = item.startswith("-"), item.lstrip("-").strip()
        if body.upper() == "NULL":
            hit = x is None
        elif body.upper() == "EMPTY":
            hit = not x
        else:
            hit = x is not None and re.fullmatch(re.escape(body).replace("%", ".*"), x, re.S) is not None
        (without if out else wanted).append(hit)
    return (any(wanted) if wanted else True) and not any(without)


TEXTS = ["a", "b", "ab", "a_b", "it's", "", None, "a%b", "NULLs"]


@pytest.mark.parametrize("value", ["a", "a, b", "-a", "-a, -b", "a%, -ab", "%b", "%_%", "-%b, -NULL", "EMPTY", "NULL, a", "it's", "-EMPTY", "-NULL"])
def test_text_filters(spark, value):
    sql = spark.range(1).select(measures.filter_condition(F.lit("x"), F.lit("string"), F.lit(value))).first()[0]
    got = [r.x for r in spark.createDataFrame([(t,) for t in TEXTS], "x string").filter(sql).collect()]
    assert got == [t for t in TEXTS if text_keeps(value, t)], sql


NUMBERS = [-3.0, 0.0, 1.0, 4.5, 5.0, 7.0, 10.0, None]
CASES = {
    "5": lambda x: x == 5,
    "1, 5, 7": lambda x: x in (1, 5, 7),
    "NOT 5": lambda x: x != 5,
    "<> 5, !=7": lambda x: x not in (5, 7),
    ">=5": lambda x: x is not None and x >= 5,
    "1 to 5": lambda x: x is not None and 1 <= x <= 5,
    "[1, 5)": lambda x: x is not None and 1 <= x < 5,
    "(-inf, 0], (5, inf)": lambda x: x is not None and (x <= 0 or x > 5),
    "[0, 10], NOT 7": lambda x: x is not None and 0 <= x <= 10 and x != 7,
    "NULL": lambda x: x is None,
    "NOT NULL": lambda x: x is not None,
    "-3": lambda x: x == -3,
}


@pytest.mark.parametrize("value", CASES)
def test_number_filters(spark, value):
    sql = spark.range(1).select(measures.filter_condition(F.lit("x"), F.lit("number"), F.lit(value))).first()[0]
    got = [r.x for r in spark.createDataFrame([(n,) for n in NUMBERS], "x double").filter(sql).collect()]
    assert got == [n for n in NUMBERS if CASES[value](n)], sql


def test_filters_that_are_not_understood(spark):
    cases = [("number", "> 5 AND < 10"), ("number", "five"), ("number", "[,]"), ("string", "a^%b"), ("string", "a%b"), ("string", ""), ("yesno", "maybe"), ("time", "last 3 months"), ("date", "2020")]
    frame = spark.createDataFrame(cases, "kind string, value string")
    assert all(r[0] is None for r in frame.select(measures.filter_condition(F.lit("x"), F.col("kind"), F.col("value"))).collect())


def test_measure_formulas(spark):
    fields = [
        ("v", "net", "number", "${TABLE}.price - ${TABLE}.cost"),
        ("v", "loss", "yesno", "${net} < 0"),
        ("w", "kind", None, "lower(${TABLE}.kind)"),
        ("v", "a", "number", "${b}"),
        ("v", "b", "number", "${a}"),
    ]
    rows = [
        ("v", "plain", "SUM", "${net}", None),
        ("v", "n", "count", None, ""),
        ("v", "losses", "count", None, 'loss: "yes"'),
        ("v", "far", "max", "${TABLE}.price", 'w.kind: "x", loss: "no"'),
        ("v", "column", "count", None, 'state: "open"'),
        ("v", "elsewhere", "count", None, 'w.missing: "x"'),
        ("v", "odd", "count", None, 'loss: "yes" and more'),
        ("v", "kind", "percentile", "${net}", None),
        ("v", "round", "sum", "${a}", None),
        ("v", "lost", "sum", "${gone}", None),
        ("v", "nothing", "sum", None, None),
    ]
    got = measures.measure_formulas(
        spark.createDataFrame(rows, "view_name string, measure_name string, type string, sql string, filters string"),
        spark.createDataFrame(fields, "view_name string, field_name string, type string, sql string"),
    )
    found = {r["name"]: (r["status"], r["formula"]) for r in got.collect()}
    assert len(found) == len(rows)
    assert found["plain"] == ("ok", "SUM((price - cost))")
    assert found["n"] == ("ok", "COUNT(1)")
    assert found["losses"] == ("ok", "COUNT(CASE WHEN ((price - cost) < 0) THEN 1 END)")
    assert found["far"] == ("ok", "MAX(CASE WHEN ((lower(kind)) = 'x') AND NOT coalesce(((price - cost) < 0), false) THEN price END)")
    assert found["column"] == ("ok", "COUNT(CASE WHEN state IN ('open') THEN 1 END)")
    assert {n: found[n][0] for n in ("elsewhere", "odd", "kind", "nothing")} == dict.fromkeys(("elsewhere", "odd", "kind", "nothing"), "unsupported")
    assert found["round"] == ("cycle", None) and found["lost"] == ("unknown", None)


def test_evaluated_measures(spark):
    data = {"t": spark.createDataFrame([(1.0, "a"), (2.0, "b"), (None, "b")], "x double, y string")}
    formulas = spark.createDataFrame(
        [("v", "total", "ok", "SUM(x)"), ("v", "last", "ok", "MAX(y)"), ("v", "wrong", "ok", "SUM(z)"), ("v", "off", "unsupported", None), ("gone", "n", "ok", "COUNT(1)")],
        "view_name string, name string, status string, formula string",
    )
    sources = spark.createDataFrame([("v", "t")], "view_name string, source string")
    got = {(r.view_name, r.name): tuple(r)[2:] for r in measures.evaluate_catalog(spark, formulas, sources, data.__getitem__).collect()}
    assert got == {
        ("v", "total"): ("ok", 3.0, None), ("v", "last"): ("ok", None, "b"), ("v", "wrong"): ("invalid", None, None),
        ("v", "off"): ("unsupported", None, None), ("gone", "n"): ("invalid", None, None),
    }


def test_changes_below_a_millisecond_count(spark):
    row = lambda at, tags: spark.createDataFrame([("n", at, tags)], "note_id string, at string, tags array<string>").select(
        "note_id", *[F.lit("x").alias(c) for c in ("schema_name", "kind", "content")], "tags", F.to_timestamp("at").alias("created_at"),
        *[F.lit(None).alias(c) for c in ("title", "author", "source", "confidence", "importance", "updated_at")],
    )
    counted = lambda a, b: [r.change for r in change_counts(NOTES_ON_SCHEMATA.conform(a), NOTES_ON_SCHEMATA.conform(b), NOTES_ON_SCHEMATA).collect()]
    first = row("2024-01-01 00:00:00.123456", ["a", None])
    assert counted(first, first) == ["unchanged"]
    assert counted(first, row("2024-01-01 00:00:00.123999", ["a", None])) == ["updated"]
    assert counted(first, row("2024-01-01 00:00:00.123456", [None, "a"])) == ["updated"]
    empty = spark.createDataFrame([], DBT_MODEL.schema)
    assert change_counts(empty, empty, DBT_MODEL).isEmpty()


def test_metric_over_an_unknown_dataset_stays(spark):
    expressions = "array<struct<dialect:string,expression:string>>"
    rows = spark.createDataFrame([("m", "a", [("ANSI_SQL", "SUM(known.x) / SUM(gone.y)")])], f"model_name string, name string, expressions {expressions}")
    sets = spark.createDataFrame([("m", "known", "wh.known", None)], "model_name string, name string, source string, ai_context string")
    got = {r["dataset"]: r["source"] for r in metrics.metric_sources(rows, sets).collect()}
    assert got == {"known": "wh.known", "gone": None}
