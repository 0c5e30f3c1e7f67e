"""Graphs, search, matching across sources and metric evaluation."""

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from ctxlake.operators import graph, search
from ctxlake.operators import osi
from ctxlake.plans import metrics
from ctxlake.sources.yamldoc import parse_yaml


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*(columns or ["*"])).collect()), key=str)


def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "upstream_id string, downstream_id string")


def nodes(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "node_id string")


def test_closure_has_shortest_depth_and_ends_on_cycles(spark):
    e = edges(spark, ("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "b"), ("x", "y"), ("d", "d"))
    assert rows(graph.downstream(e, nodes(spark, "a"))) == [("b", 1), ("c", 1), ("d", 2)]
    assert rows(graph.downstream(e, nodes(spark, "b"))) == [("b", 3), ("c", 1), ("d", 2)]
    assert rows(graph.upstream(e, nodes(spark, "d")), "node_id") == [("a",), ("b",), ("c",), ("d",)]
    assert rows(graph.downstream(e, nodes(spark, "y"))) == []


def test_closure_equals_recursive_sql_on_a_dag(spark):
    rng = random.Random(3)
    pairs = [(f"n{i}", f"n{rng.randrange(i + 1, 60)}") for i in range(59) for _ in range(2)]
    frame = edges(spark, *pairs)
    frame.createOrReplaceTempView("dag_edges")
    expected = spark.sql(
        """WITH RECURSIVE l AS (
             SELECT downstream_id AS node_id FROM dag_edges WHERE upstream_id = 'n0'
             UNION ALL SELECT d.downstream_id FROM dag_edges d JOIN l ON d.upstream_id = l.node_id)
           SELECT DISTINCT node_id FROM l"""
    )
    assert rows(graph.downstream(frame, nodes(spark, "n0")), "node_id") == rows(expected)


def test_lineage_keeps_models_only(spark):
    models = spark.createDataFrame(
        [("m.a", "a", "s", "d"), ("m.b", "b", None, "")], "unique_id string, name string, schema_name string, description string"
    )
    e = edges(spark, ("src", "m.a"), ("m.a", "m.b"), ("m.a", "exposure.x"))
    assert rows(graph.lineage_models(e, models, nodes(spark, "src"))) == [("a", "s", "d"), ("b", None, "")]


def test_reachable_views_stay_in_their_topic(spark):
    topics = spark.createDataFrame([("t1", "a"), ("t2", "b")], "topic_name string, base_view string")
    joins = spark.createDataFrame(
        [("t1", "a", "b"), ("t1", "b", "c"), ("t2", "b", "z")], "topic_name string, from_view string, to_view string"
    )
    assert rows(graph.reachable_views(topics, joins)) == [("t1", "b", 1), ("t1", "c", 2), ("t2", "z", 1)]


def test_join_paths_are_shortest_per_model(spark):
    links = spark.createDataFrame(
        [("m", "r1", "a", "b"), ("m", "r2", "b", "c"), ("m", "r3", "a", "c"), ("m", "r4", "c", "a"), ("n", "q", "a", "z")],
        "model_name string, name string, from_dataset string, to_dataset string",
    )
    found = {(r["model_name"], r["from_dataset"], r["to_dataset"]): r["path"] for r in graph.join_paths(links).collect()}
    assert found[("m", "a", "c")] == ["r3"] and found[("m", "b", "a")] == ["r2", "r4"]
    assert ("n", "a", "b") not in found and len(found) == 7


def like(text, pattern):
    """Brute force: does ``text`` contain a match of a LIKE body?"""
    import re

    body = "".join("." if c == "_" else ".*" if c == "%" else re.escape(c) for c in pattern)
    return re.search(body, text, re.S) is not None


@pytest.mark.parametrize("literal", [False, True])
def test_view_model_match_equals_comparing_all_pairs(spark, literal):
    rng = random.Random(11)
    alphabet = "ab_.%é\\!\n"

    def word(low, high):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))

    views = [(f"v{i}", rng.choice(['"W".', "", "X"]) + word(0, 4) + "." + word(0, 6)) for i in range(150)]
    views += [("none", None), ("empty", ""), ("upper", 'DB.Sales_X."T".SALES_X.ORDERS_1 AS o'), ("copy", views[0][1])]
    models = [(f"m{i}", word(0, 4), word(0, 4), "d") for i in range(120)]
    models += [("m.null", None, "a", ""), ("m.noname", "a", None, ""), ("m.all", "%", "%", ""), ("m.s", "sales_x", "orders_1", "x")]
    view_rows = spark.createDataFrame(views, "name string, sql_table_name string")
    model_rows = spark.createDataFrame(models, "unique_id string, schema_name string, name string, description string")
    found = rows(search.match_views_to_models(view_rows, model_rows, literal=literal), "lookml_view", "dbt_model_id")
    expected = []
    for view, ref in views:
        hits = []
        for model, schema, name, _ in models:
            if ref is not None and schema is not None and name is not None:
                pattern, text = f"{schema}.{name}".lower(), ref.lower()
                if (pattern in text) if literal else like(text, pattern):
                    hits.append(model)
        expected += [(view, m) for m in hits or [None]]
    assert found == sorted(expected, key=str)
    assert sum(m is not None for _, m in expected) > 150


def test_view_model_match_with_one_hot_name(spark):
    views = spark.range(400).select(F.format_string("v%d", "id").alias("name"), F.lit("w.mart.orders").alias("sql_table_name"))
    models = spark.createDataFrame([("m1", "mart", "orders", ""), ("m2", "mart", "order", ""), ("m3", "other", "x", "")],
                                   "unique_id string, schema_name string, name string, description string")
    found = search.match_views_to_models(views, models)
    assert rows(found.groupBy("dbt_model_id").count()) == [("m1", 400), ("m2", 400)]


def test_keyword_search(spark):
    frame = spark.createDataFrame(
        [("net_revenue", "Money in", None), ("churn", None, '"lost 50% of all"')], "name string, description string, ai_context string"
    )
    assert rows(search.search(frame, "osi_metric", ["REVENUE", "money", "lost"]), "name", "keyword") == [
        ("churn", "lost"), ("net_revenue", "REVENUE"), ("net_revenue", "money")
    ]
    assert rows(search.search(frame, "osi_metric", ["net%money", "50%"], literal=True), "name") == [("churn",)]
    assert rows(search.search(frame, "osi_metric", ["net%money"]), "name") == [("net_revenue",)]
    assert rows(search.keyword_outcome(frame, "osi_metric", ["money", "gone"])) == [("gone", 0), ("money", 1)]


def test_usable_skills_add_up_without_repeats(spark):
    uses = spark.createDataFrame(
        [("p", "k1", "schema", "S"), ("p", "k1", "table", "S.T"), ("p", "k2", "table", "S.T"), ("q", "k1", "table", "S.U.V")],
        "provider string, skill_key string, use_kind string, object_ref string",
    )
    objects = spark.createDataFrame([("S", "T"), ("S", "U.V"), ("X", "Y")], "schema_name string, table_name string")
    assert rows(search.usable_skills(uses, objects)) == [
        ("S", "T", "p", "k1"), ("S", "T", "p", "k2"), ("S", "U.V", "p", "k1"), ("S", "U.V", "q", "k1")
    ]
    assert rows(search.usable_skill_counts(uses, objects)) == [("S", "T", 2), ("S", "U.V", 2), ("X", "Y", 0)]
    assert rows(search.skills_for(uses, "S", "T")) == [("p", "k1"), ("p", "k2")]


def test_formula_expansion(spark):
    fields = spark.createDataFrame(
        [("v", "a", "${TABLE}.a"), ("v", "b", "${a} + 1"), ("w", "x", "${v.b} * 2"), ("v", "loop", "${loop2}"), ("v", "loop2", "${loop}"),
         ("v", "cond", "{% if x %} 0 {% else %} ${a} {% endif %}")],
        "view_name string, name string, sql string",
    )
    asked = spark.createDataFrame(
        [("v", "m1", "${b}"), ("w", "m2", "${x} - ${v.a}"), ("v", "m3", "${gone}"), ("v", "m4", "${loop}"), ("v", "m5", "${cond}"), ("v", "m6", None)],
        "view_name string, name string, sql string",
    )
    found = {r["name"]: (r["status"], r["resolved"]) for r in metrics.expand_formulas(asked, fields).collect()}
    assert found["m1"] == ("ok", "(a + 1)")
    assert found["m2"] == ("ok", "((a + 1) * 2) - a")
    assert found["m3"][0] == "unknown" and found["m4"] == ("cycle", "${v.loop}")
    assert found["m5"] == ("ok", "a") and found["m6"] == ("ok", None)


def test_formula_chains_of_any_length_and_cycles(spark):
    chain = [("v", f"f{k}", f"${{f{k + 1}}}") for k in range(25)] + [("v", "f25", "${TABLE}.x + 1"), ("v", "me", "${me} + ${me} * ${me}")]
    fields = spark.createDataFrame(chain, "view_name string, name string, sql string")
    asked = spark.createDataFrame([("v", "long", "${f0}"), ("v", "round", "${me}"), ("v", "both", "${f3} + ${me}")], "view_name string, name string, sql string")
    found = {r["name"]: (r["status"], r["resolved"]) for r in metrics.expand_formulas(asked, fields).collect()}
    assert found == {"long": ("ok", "(x + 1)"), "round": ("cycle", "${v.me}"), "both": ("cycle", "${v.f3} + ${v.me}")}


def test_measure_filters(spark):
    asked = {
        's: "-x"': "(s NOT IN ('x') OR s IS NULL)", 's: "-x, -y"': "(s NOT IN ('x','y') OR s IS NULL)", 'a: ">5"': "a > 5", 'a: "<= -2.5"': "a <= -2.5",
        'n: "A%"': "n LIKE 'A%'", "p: yes": "p", 'p: "No"': "NOT coalesce(p, false)", 's: "NULL"': "s IS NULL", 's: "-NULL"': "s IS NOT NULL",
        's: "a", t: ">1"': "s IN ('a') AND t > 1", 's: "x, -y"': None, 'd: "last 7 days"': None, 'a: "[1, 5]"': None, 's: "EMPTY"': None, "?": None,
        's: "a", ?': None, 'd: "7 days"': None, 'a: "1 to 5"': None,
    }
    frame = spark.createDataFrame([(f,) for f in asked], "f string")
    found = {r[0]: r[1] for r in frame.select("f", metrics.measure_formula(F.lit("count"), F.lit(None).cast("string"), F.col("f"))).collect()}
    assert found == {f: c and f"COUNT(CASE WHEN {c} THEN 1 END)" for f, c in asked.items()}


def test_measure_formulas(spark):
    frame = spark.createDataFrame(
        [("count", None, None), ("count", "id", None), ("SUM", "x", 's: "a"'), ("count", None, "s: \"a, b'c\", v.t: \"1\""),
         ("count_distinct", "x", None), ("average", "x", None), ("median", "x", None)],
        "k string, s string, f string",
    )
    found = [r[0] for r in frame.select(metrics.measure_formula(F.col("k"), F.col("s"), F.col("f"))).collect()]
    assert found == [
        "COUNT(1)", "COUNT(id)", "SUM(CASE WHEN s IN ('a') THEN x END)",
        "COUNT(CASE WHEN s IN ('a','b''c') AND t IN ('1') THEN 1 END)", "COUNT(DISTINCT x)", "AVG(x)", None,
    ]
    quoted = frame.limit(1).select(metrics.omni_measure_formula(F.lit("sum"), F.lit('"AMOUNT"'))).first()[0]
    assert quoted == "SUM(AMOUNT)"


MODEL = """
version: "0.2.0.dev0"
semantic_model:
  - name: m
    datasets:
      - name: sales
        source: db.sales
        primary_key: [id]
        fields:
          - {name: sold_on, dimension: {is_time: true}, expression: {dialects: [{dialect: ANSI_SQL, expression: sold_on}]}}
          - {name: total, expression: {dialects: [{dialect: ANSI_SQL, expression: price * n}]}}
      - name: store
        source: db.store
        primary_key: [region, id]
        fields:
          - {name: label, expression: {dialects: [{dialect: ANSI_SQL, expression: "region || '-' || id"}]}}
      - {name: owner, source: db.owner, primary_key: [id]}
    relationships:
      - {name: s, from: sales, to: store, from_columns: [region, store_id], to_columns: [region, id]}
      - {name: o, from: store, to: owner, from_columns: [owner_id], to_columns: [id]}
    metrics:
      - {name: revenue, expression: {dialects: [{dialect: SNOWFLAKE, expression: SUM(wrong)}, {dialect: ANSI_SQL, expression: SUM(sales.total)}]}}
      - {name: per_owner, expression: {dialects: [{dialect: ANSI_SQL, expression: SUM(sales.total) / COUNT(DISTINCT owner.id)}]}}
      - {name: per_head, expression: {dialects: [{dialect: ANSI_SQL, expression: "SUM(sales.total) / NULLIF(SUM(store.staff), 0)"}]}}
      - {name: mixed, expression: {dialects: [{dialect: ANSI_SQL, expression: "MAX(sales.price) - MIN(sales.price) + COUNT(*) * 100"}]}}
"""


@pytest.fixture
def model(spark, docs):
    parsed = osi.model_rows(parse_yaml(docs({"m.osi.yaml": MODEL})))
    return metrics.load_model({**osi.family(parsed), "osi_field": osi.fields(parsed, with_model=True)}, "m")


@pytest.fixture
def read(spark):
    tables = {
        "db.sales": spark.createDataFrame(
            [(1, "n", 1, 10, 1, "2023-05-01"), (2, "n", 1, 20, 2, "2023-05-09"), (3, "n", 2, 5, 1, "2024-02-01"),
             (4, "s", 1, 7, 1, "2024-03-05"), (5, "s", 9, 1, 1, "2024-03-31")],
            "id int, region string, store_id int, price int, n int, sold_on string",
        ).withColumn("sold_on", F.to_timestamp("sold_on")),
        "db.store": spark.createDataFrame(
            [("n", 1, 4, 1), ("n", 2, 6, 2), ("s", 1, 10, 1)], "region string, id int, staff int, owner_id int"
        ),
        "db.owner": spark.createDataFrame([(1, "ann"), (2, "bo")], "id int, name string"),
    }
    return tables.__getitem__


def test_metrics_follow_relationships(model, read):
    by_label = rows(metrics.evaluate(model, ["revenue"], read, group_by=["store.label"]))
    assert by_label == [("n-1", 50), ("n-2", 5), ("s-1", 7), (None, 1)]
    by_owner = rows(metrics.evaluate(model, ["revenue", "mixed"], read, group_by=["owner.name"]))
    assert by_owner == [("ann", 57, 313), ("bo", 5, 100), (None, 1, 100)]
    own = metrics.evaluate(model, ["revenue"], read, group_by=["sales.region", "owner.name"])
    assert rows(own) == [("n", "ann", 50), ("n", "bo", 5), ("s", "ann", 7), ("s", None, 1)]
    some = metrics.evaluate(model, ["revenue"], read, group_by=["store.label"], where="sales.price > 9")
    assert rows(some) == [("n-1", 50)]
    assert metrics.evaluate(model, ["revenue"], read).first()[0] == 63


def test_facts_are_reduced_before_the_join(model, read, spark):
    plan = metrics.evaluate(model, ["revenue"], read, group_by=["store.label"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2 and plan.index("Join") < plan.rindex("Aggregate [")


@pytest.mark.parametrize(
    "group_by,where",
    (([], "store.staff < 10"), (["store.label"], None), (["owner.name"], "sales.price > 5"), (["sales.region", "owner.name"], "owner.name = 'ann'")),
)
def test_reduced_facts_give_what_the_joined_rows_give(model, read, group_by, where):
    formulas = {
        "a": "SUM(sales.price) / COUNT(*)", "b": "COUNT(DISTINCT store.id)", "c": "SUM(store.staff) - MIN(store.staff)",
        "d": "COUNT(owner.name)", "e": "MAX(owner.name)", "f": "COUNT(DISTINCT owner.id) + MAX(sales.price)", "g": "SUM(CAST(store.staff AS DECIMAL(9,2)))",
    }
    wide = dataclasses.replace(model, metrics=formulas)
    names = [*formulas] if not group_by else ["a", "c", "d", "e", "g"]
    for chosen in (names, ["b", "a"], ["f", "g"]):
        found = metrics.evaluate(wide, chosen, read, group_by=group_by, where=where)
        joined = metrics.star(wide, ["sales", "store", "owner"], read)
        joined = joined.filter(where) if where else joined
        plain = metrics._grouped(joined, group_by, [F.expr(formulas[n]).alias(n) for n in chosen])
        assert rows(found) == rows(plain) and found.dtypes == plain.dtypes


def test_sides_are_reduced_apart(spark, model, read):
    """A fork: each relationship of the base is reduced alone, and groups meet."""
    links = [*model.relationships, ("sales", "seller", ("n",), ("id",))]
    wide = dataclasses.replace(
        model, sources={**model.sources, "seller": "db.seller"}, keys={**model.keys, "seller": ("id",)}, fields={**model.fields, "seller": {}},
        relationships=links, metrics={"x": "SUM(sales.price)", "y": "SUM(seller.pay)", "z": "COUNT(DISTINCT owner.name)"},
    )
    seller = spark.createDataFrame([(1, 1.5), (2, 2.0)], "id int, pay double")
    both = lambda name: seller if name == "db.seller" else read(name)
    for group_by in ([], ["store.label"], ["seller.id"]):
        found = metrics.evaluate(wide, ["x", "y", "z"], both, group_by=group_by)
        joined = metrics.star(wide, ["sales", "seller", "store", "owner"], both)
        plain = metrics._grouped(joined, group_by, [F.expr(sql).alias(n) for n, sql in wide.metrics.items()])
        assert rows(found) == rows(plain)
    plan = metrics.evaluate(wide, ["x", "y", "z"], both)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") >= 4


def test_fan_out_and_grain(model, read):
    plain = metrics.evaluate(model, ["per_head"], read).first()[0]
    safe = metrics.evaluate(model, ["per_head"], read, grain_safe=True).first()[0]
    assert plain == pytest.approx(63 / (4 + 4 + 6 + 10)) and safe == pytest.approx(63 / 20)
    grouped = dict(rows(metrics.evaluate(model, ["per_head"], read, group_by=["sales.region"], grain_safe=True)))
    assert grouped == {"n": pytest.approx(55 / 10), "s": pytest.approx(8 / 10)}


def test_all_metrics_in_one_pass(model, read):
    found = dict(rows(metrics.evaluate_all(model, read)))
    assert found["revenue"] == 63 and found["per_owner"] == pytest.approx(31.5) and found["mixed"] == 519


def test_periods(model, read):
    time = metrics.time_field(model, "sales")
    ask = lambda year: metrics.year_to_date(model, "revenue", read, time=time, year=year).first()
    assert (ask(2023)["revenue"], ask(2023)["year"]) == (50, 2023)
    old = ask(2030)
    assert (old["revenue"], old["year"], str(old["to_time"])) == (13, 2024, "2024-03-31 00:00:00")
    month = metrics.latest_period(model, "revenue", read, time=time).first()
    assert (month["revenue"], str(month["month"])) == (8, "2024-03-01 00:00:00")
    with pytest.raises(LookupError):
        metrics.time_field(model, "owner")


def test_unreachable_datasets(model, read):
    with pytest.raises(ValueError, match="reaches"):
        metrics.base_dataset(model, ["owner", "store", "unlinked"])
    assert metrics.base_dataset(model, ["owner", "sales"]) == "sales"


def test_presentation(spark):
    frame = spark.createDataFrame([(1234567.5, 0.12345), (-12.4, 1.0)], "a double, b double")
    shown = metrics.presented(frame, {"a": "currency", "b": "percent"}, {"a": "SUM(x)", "b": "r"})
    assert rows(shown, "a_shown", "b_shown", "a_formula") == [("$1,234,568", "12.3%", "SUM(x)"), ("-$12", "100.0%", "SUM(x)")]
