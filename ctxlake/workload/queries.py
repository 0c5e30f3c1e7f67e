"""Every operator as a query over the given tables: ``name → f(spark, sf_dir)``."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.text import plain_identifier
from ..operators import checks, context, contract, graph, lookml, manifest, notes, omni, osi
from ..operators import registry, search, skills, store
from ..plans import measures, metrics
from ..runtime import run_folder, staged
from ..sources.lookml import parse_lookml
from ..sources.manifest import read_manifests
from ..sources.scan import listing, text_documents
from ..sources.yamldoc import parse_yaml, rejects
from ..specs import ALL_TABLES, LOOKML_VIEW, ROOT, SKILL_USE, TableSpec
from ..streaming import ledger
from ..streaming.refresh import document_stream, refresh_lookml_stream
from . import derived as d

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _csv(col: str | Column) -> Column:
    return F.array_join(F.array_sort(col), ",")


def _time(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def _utc(col: str) -> Column:
    return F.date_format(F.to_utc_timestamp(col, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")


def _nodes(spark: SparkSession, *ids: str) -> DataFrame:
    return spark.createDataFrame([(i,) for i in ids], "node_id string")


# --- manifests ---


def _model_columns(models: DataFrame) -> DataFrame:
    return models.withColumns(
        {
            "tags": _csv("tags"),
            "owner": F.get_json_object("meta", "$.owner"),
            "tier": F.get_json_object("meta", "$.tier"),
        }
    ).drop("meta")


@query
def dbt_model(spark, sf):
    return _model_columns(manifest.models(d.manifest_nodes(spark, sf)))


@query
def dbt_column(spark, sf):
    return manifest.columns(d.manifest_nodes(spark, sf))


@query
def dbt_dependency(spark, sf):
    return manifest.dependencies(d.manifest_nodes(spark, sf))


@query
def manifest_files(spark, sf):
    """Manifests written as line-delimited files and read back with a fixed schema."""
    folder = run_folder(spark, "manifests")
    d.manifest_documents(spark, sf).select("content").write.text(folder)
    nodes = manifest.model_nodes(read_manifests(spark, folder, multiline=False))
    return _model_columns(manifest.models(nodes))


@query
def dbt_lineage(spark, sf):
    """Models that depend, directly or not, on one source."""
    nodes = staged(d.manifest_nodes(spark, sf), "nodes")
    return graph.lineage_models(
        manifest.dependencies(nodes), manifest.models(nodes), _nodes(spark, "source.raw.n7")
    )


# --- LookML ---


@query
def lookml_view(spark, sf):
    return lookml.views(d.lookml_blocks(spark, sf))


@query
def lookml_dimension(spark, sf):
    return lookml.dimensions(d.lookml_blocks(spark, sf))


@query
def lookml_measure(spark, sf):
    return lookml.measures(d.lookml_blocks(spark, sf))


@query
def lookml_explore(spark, sf):
    return lookml.explores(d.lookml_blocks(spark, sf))


@query
def lookml_rejects(spark, sf):
    return lookml.rejects(parse_lookml(d.lookml_documents(spark, sf, broken=True))).select("file_path")


@query
def lookml_files(spark, sf):
    """LookML written to files of a bounded size and scanned back as whole files."""
    folder = run_folder(spark, "lookml-files")
    texts = d.lookml_documents(spark, sf).select("content")
    texts.write.option("maxRecordsPerFile", 20).text(folder)
    return lookml.views(parse_lookml(text_documents(spark, folder, ".txt"))).drop("file_path")


@query
def lookml_last_file_wins(spark, sf):
    """Views defined again in a later file: the later path counts."""
    again = d.lookml_documents(spark, sf).select(
        F.concat(F.lit("zz/"), "file_path").alias("file_path"),
        F.replace("content", F.lit("Use for"), F.lit("Now for")).alias("content"),
    )
    both = parse_lookml(d.lookml_documents(spark, sf).unionByName(again.filter("file_path LIKE '%0.view.lkml'")))
    newest = store.last_write_wins(lookml.views(both), LOOKML_VIEW.keys, "file_path")
    return newest.select("name", "ai_context", "file_path")


@query
def lookml_formulas(spark, sf):
    """Every measure as aggregate SQL, with field references, table references, conditionals and filters resolved."""
    blocks = staged(d.lookml_blocks(spark, sf), "lookml")
    return measures.measure_formulas(lookml.measures(blocks), lookml.dimensions(blocks))


_ORDER_LINES = """
view: lineitem {
  sql_table_name: shop.lineitem ;;
  dimension: net { type: number sql: CAST(${TABLE}.l_extendedprice * (1 - ${TABLE}.l_discount) AS DECIMAL(24,4)) ;; }
  measure: lines { type: count }
  measure: returned_lines { type: count filters: [l_returnflag: "R"] }
  measure: closed_or_open { type: count filters: [l_returnflag: "A, N", lineitem.l_linestatus: "O"] }
  measure: net_total { type: sum sql: ${net} ;; }
  measure: net_returned { type: sum sql: ${net} ;; filters: [l_returnflag: "R"] }
  measure: average_quantity { type: average sql: ${TABLE}.l_quantity ;; }
  measure: first_ship { type: min sql: ${TABLE}.l_shipdate ;; }
  measure: last_ship { type: max sql: ${TABLE}.l_shipdate ;; }
  measure: parts { type: count_distinct sql: ${TABLE}.l_partkey ;; }
  measure: odd { type: percentile sql: ${TABLE}.l_quantity ;; }
}
"""


def line_measures(spark: SparkSession) -> DataFrame:
    docs = spark.createDataFrame([("l.view.lkml", _ORDER_LINES)], "file_path string, content string")
    blocks = parse_lookml(docs)
    measures = lookml.measures(blocks)
    fields = lookml.dimensions(blocks).select("view_name", F.col("field_name").alias("name"), "sql")
    expanded = metrics.expand_formulas(
        measures.select("view_name", F.col("measure_name").alias("name"), F.coalesce("sql", F.lit("")).alias("sql")),
        fields,
    )
    rules = measures.select("view_name", F.col("measure_name").alias("name"), "type", "filters")
    sql = F.nullif(F.col("resolved"), F.lit(""))
    return expanded.join(rules, ["view_name", "name"]).select(
        "name", metrics.measure_formula(F.col("type"), sql, F.col("filters")).alias("formula")
    )


@query
def measure_kinds(spark, sf):
    """Measures of one view, by declared kind and filters, over the line items."""
    formulas = {r["name"]: r["formula"] for r in line_measures(spark).filter("formula IS NOT NULL").collect()}
    result = metrics.evaluate_measures(d.table(spark, sf, "lineitem"), formulas, ["l_linestatus"])
    return result.select(
        "l_linestatus",
        "lines",
        "returned_lines",
        "closed_or_open",
        "parts",
        F.col("net_total").cast("double").alias("net_total"),
        F.col("net_returned").cast("double").alias("net_returned"),
        F.round("average_quantity", 4).alias("average_quantity"),
        _time("first_ship").alias("first_ship"),
        _time("last_ship").alias("last_ship"),
    )


_SHOP_VIEWS = """
view: lines {
  sql_table_name: shop.lineitem ;;
  dimension: net { type: number sql: CAST(${TABLE}.l_extendedprice * (1 - ${TABLE}.l_discount) AS DECIMAL(24,4)) ;; }
  dimension: is_returned { type: yesno sql: ${TABLE}.l_returnflag = 'R' ;; }
  dimension: status { type: string sql: lower(${TABLE}.l_linestatus) ;; }
  dimension: quantity { type: number sql: ${TABLE}.l_quantity ;; }
  dimension: big { type: yesno sql: ${quantity} > 25 AND NOT ${is_returned} ;; }
  dimension_group: shipped { type: time sql: ${TABLE}.l_shipdate ;; }
  measure: returned_net { type: sum sql: ${net} ;; filters: [is_returned: "yes"] }
  measure: kept_open { type: count filters: [is_returned: "no", status: "o, x"] }
  measure: not_open { type: count filters: [lines.status: "-o"] }
  measure: some_quantities { type: count filters: [quantity: "[1, 10), 20 to 25, 50, NOT 7"] }
  measure: big_parts { type: count_distinct sql: ${TABLE}.l_partkey ;; filters: [big: "yes"] }
  measure: last_ship { type: max sql: ${TABLE}.l_shipdate ;; }
  measure: by_column { type: count filters: [l_returnflag: "A, N"] }
  measure: recent { type: count filters: [shipped: "last 3 months"] }
  measure: middle { type: median sql: ${quantity} ;; }
  measure: lost { type: sum sql: ${nowhere} ;; }
  measure: astray { type: sum sql: ${TABLE}.no_such_column ;; }
}
view: buyers {
  sql_table_name: shop.customer ;;
  dimension: segment { type: string sql: ${TABLE}.c_mktsegment ;; }
  measure: balance { type: sum sql: CAST(${TABLE}.c_acctbal AS DECIMAL(20,2)) ;; }
  measure: builders { type: count filters: [segment: "BUILD%"] }
  measure: others { type: count filters: [segment: "-BUILDING, -%HOLD"] }
}
"""
_SHOP_OMNI = """schema: shop
table_name: part
dimensions:
  p_size: {}
measures:
  parts: {aggregate_type: count}
  brands: {aggregate_type: count_distinct, sql: '"p_brand"'}
  retail: {aggregate_type: average, sql: '"p_retailprice"'}
  spread: {aggregate_type: stddev, sql: '"p_retailprice"'}
"""


@query
def catalog_measures(spark, sf):
    """All measures of LookML and Omni views over the order tables, each with its value or the reason it has none."""
    docs = spark.createDataFrame([("shop.view.lkml", _SHOP_VIEWS)], "file_path string, content string")
    blocks = staged(parse_lookml(docs), "shop-views")
    pages = spark.createDataFrame([("shop/part.view.yaml", _SHOP_OMNI)], "file_path string, content string")
    pages = staged(omni.view_documents(parse_yaml(pages)), "shop-omni")
    nothing = F.lit(None).cast("string")
    plain = omni.measures(pages).select(
        "view_name", "measure_name", F.col("aggregate_type").alias("type"), plain_identifier(F.col("sql")).alias("sql"), nothing.alias("filters")
    )
    rows = lookml.measures(blocks).select(*plain.columns).unionByName(plain)
    kind = F.when(F.col("field_kind") == "dimension", F.col("type")).otherwise("time")
    fields = lookml.dimensions(blocks).select("view_name", "field_name", kind.alias("type"), "sql")
    sources = lookml.views(blocks).select(F.col("name").alias("view_name"), F.col("sql_table_name").alias("source"))
    sources = sources.unionByName(omni.views(pages).select("view_name", F.concat_ws(".", "schema", "table_name").alias("source")))
    result = measures.evaluate_catalog(spark, measures.measure_formulas(rows, fields), sources, d.shop_reader(spark, sf))
    return result.select("view_name", "name", "status", F.round("value", 2).alias("value"), "shown")


@query
def lookml_measure_sources(spark, sf):
    """Measures with the table and caveats of their view."""
    blocks = staged(d.lookml_blocks(spark, sf), "lookml")
    return metrics.measure_sources(lookml.measures(blocks), lookml.views(blocks))


# --- Omni ---


@query
def omni_measure_sources(spark, sf):
    """Measures with the schema, table and model documentation of their view."""
    docs = staged(d.omni_views(spark, sf), "omni")
    models = d.table(spark, sf, "part").select(
        F.format_string("model.p%d", "p_partkey").alias("unique_id"),
        F.lit("SHOP").alias("schema_name"),
        F.format_string("part_%d", "p_partkey").alias("name"),
        F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).alias("description"),
    )
    return metrics.omni_measure_sources(omni.measures(docs), omni.views(docs), models)


@query
def omni_view(spark, sf):
    return omni.views(d.omni_views(spark, sf))


@query
def omni_dimension(spark, sf):
    return omni.dimensions(d.omni_views(spark, sf))


@query
def omni_measure(spark, sf):
    return omni.measures(d.omni_views(spark, sf))


@query
def omni_measure_formulas(spark, sf):
    measures = omni.measures(d.omni_views(spark, sf))
    formula = metrics.omni_measure_formula(F.col("aggregate_type"), F.col("sql"))
    return measures.select("view_name", "measure_name", formula.alias("formula"))


@query
def omni_rejects(spark, sf):
    return rejects(parse_yaml(d.omni_view_documents(spark, sf))).select("file_path")


@query
def omni_topic(spark, sf):
    return omni.topics(d.omni_topics(spark, sf))


@query
def omni_topic_join(spark, sf):
    return omni.topic_joins(d.omni_topics(spark, sf))


@query
def topic_reach(spark, sf):
    docs = staged(d.omni_topics(spark, sf), "topics")
    reached = graph.reachable_views(omni.topics(docs), omni.topic_joins(docs))
    return reached.withColumn("depth", F.col("depth").cast("long"))


# --- OSI ---


@query
def osi_model(spark, sf):
    return osi.models(d.osi_models(spark, sf)).select(
        "name", "version", "description", _csv("synonyms").alias("synonyms")
    )


@query
def osi_dataset(spark, sf):
    return osi.datasets(d.osi_models(spark, sf)).select(
        "model_name",
        "name",
        "source",
        _csv("primary_key").alias("primary_key"),
        F.array_join(F.transform("unique_keys", lambda k: F.array_join(k, "+")), ",").alias("unique_keys"),
        "description",
        F.array_join("synonyms", ",").alias("synonyms"),
        F.coalesce(F.get_json_object("ai_context", "$.instructions"), F.get_json_object("ai_context", "$")).alias(
            "context"
        ),
        F.array_join(F.transform("custom_extensions", lambda e: F.concat(e["vendor_name"], e["data"])), ",").alias(
            "extensions"
        ),
    )


@query
def osi_field(spark, sf):
    return osi.fields(d.osi_models(spark, sf), with_model=True).select(
        "model_name",
        "dataset_name",
        "name",
        "label",
        "is_time_dimension",
        F.array_join(F.transform("expressions", lambda e: F.concat_ws("=", e["dialect"], e["expression"])), ";").alias(
            "expressions"
        ),
    )


@query
def osi_metric(spark, sf):
    return osi.metrics(d.osi_models(spark, sf)).select(
        "model_name", "name", "description", F.size("expressions").cast("long").alias("dialects")
    )


@query
def osi_relationship(spark, sf):
    return osi.relationships(d.osi_models(spark, sf)).select(
        "model_name",
        "name",
        "from_dataset",
        "to_dataset",
        _csv("from_columns").alias("from_columns"),
        _csv("to_columns").alias("to_columns"),
    )


@query
def osi_violations(spark, sf):
    parsed = staged(parse_yaml(d.osi_documents(spark, sf, broken=True)), "osi")
    return contract.osi_violations(parsed).select("file_path", "path", "rule")


@query
def osi_join_paths(spark, sf):
    paths = graph.join_paths(osi.relationships(d.osi_models(spark, sf)))
    return paths.select(
        "model_name", "from_dataset", "to_dataset", F.col("hops").cast("long").alias("hops"),
        F.array_join("path", ",").alias("path"),
    )


@query
def metric_dialects(spark, sf):
    """The formula chosen for a requested dialect, with its fallbacks."""
    found = osi.metrics(d.osi_models(spark, sf))
    return found.select(
        "model_name", "name", metrics.formula(F.col("expressions"), "SNOWFLAKE").alias("snowflake"),
        metrics.formula(F.col("expressions")).alias("plain"),
    )


@query
def time_dimensions(spark, sf):
    fields = osi.fields(d.osi_models(spark, sf), with_model=True)
    return fields.filter("is_time_dimension").select(
        "model_name", "dataset_name", "name", metrics.formula(F.col("expressions")).alias("formula")
    )


@query
def metric_sources(spark, sf):
    rows = osi.model_rows(staged(parse_yaml(d.osi_documents(spark, sf)), "osi"))
    return metrics.metric_sources(osi.metrics(rows), osi.datasets(rows))


@query
def dataset_model_docs(spark, sf):
    """Datasets joined with the models their source names, ignoring case."""
    sets = osi.datasets(d.osi_models(spark, sf)).select(
        "model_name",
        F.col("name").alias("dataset"),
        F.split_part("source", F.lit("."), F.lit(2)).alias("schema_part"),
        F.split_part("source", F.lit("."), F.lit(3)).alias("table_part"),
    )
    nodes = staged(d.manifest_nodes(spark, sf), "nodes")
    docs = search.attach_model_docs(sets, manifest.models(nodes), "schema_part", "table_part")
    keyed = docs.withColumn("wanted", F.lit("C_ACCTBAL"))
    return search.attach_column_docs(keyed, manifest.columns(nodes), "wanted").select(
        "model_name", "dataset", "dbt_model_id", "dbt_description", "data_type"
    )


# --- governed metrics over the order tables ---


def _shop(spark: SparkSession) -> metrics.Model:
    return metrics.load_model(d.shop_tables(spark), "shop")


@query
def revenue_by_brand(spark, sf):
    result = metrics.evaluate(_shop(spark), ["revenue"], d.shop_reader(spark, sf), group_by=["part.p_brand"])
    return result.select("p_brand", F.col("revenue").cast("double").alias("revenue"))


@query
def revenue_by_customer_name(spark, sf):
    """Grouped by a computed field two relationships away."""
    result = metrics.evaluate(
        _shop(spark), ["revenue", "order_count"], d.shop_reader(spark, sf), group_by=["customer.display_name"]
    )
    return result.select("display_name", F.col("revenue").cast("double").alias("revenue"), "order_count")


@query
def all_metrics(spark, sf):
    result = metrics.evaluate_all(_shop(spark), d.shop_reader(spark, sf))
    return result.select("metric", F.round("value", 2).alias("value"))


@query
def grain_safe_ratio(spark, sf):
    result = metrics.evaluate(
        _shop(spark), ["revenue_to_balance"], d.shop_reader(spark, sf),
        group_by=["part.p_brand"], grain_safe=True,
    )
    return result.select("p_brand", F.round(F.col("revenue_to_balance").cast("double"), 4).alias("ratio"))


@query
def revenue_year_to_date(spark, sf):
    """No rows in the asked year, so the latest year of the data is used and named."""
    result = metrics.year_to_date(
        _shop(spark), "revenue", d.shop_reader(spark, sf), time="orders.o_orderdate", year=2026,
        group_by=["customer.c_mktsegment"],
    )
    return result.select(
        "c_mktsegment", F.col("revenue").cast("double").alias("revenue"), F.col("year").cast("long").alias("year"),
        _time("from_time").alias("from_time"), _time("to_time").alias("to_time"),
    )


@query
def revenue_latest_month(spark, sf):
    result = metrics.latest_period(
        _shop(spark), "revenue", d.shop_reader(spark, sf), time="lineitem.l_shipdate", grain="month"
    )
    return result.select(
        F.col("revenue").cast("double").alias("revenue"), _time("month").alias("month"),
        _time("from_time").alias("from_time"), _time("to_time").alias("to_time"),
    )


@query
def presented_metrics(spark, sf):
    model = _shop(spark)
    result = metrics.evaluate(
        model, ["revenue", "returned_share"], d.shop_reader(spark, sf), group_by=["part.p_type"]
    )
    shown = metrics.presented(result, {"revenue": "currency", "returned_share": "percent"}, model.metrics)
    return shown.select("p_type", "revenue_shown", "returned_share_shown", "revenue_formula")


# --- skills ---


@query
def skill_root(spark, sf):
    roots = skills.root_rows(d.skill_documents(spark, sf), "acme")
    return registry.skill_listing(roots).select("provider", "key", F.md5("content").alias("content_md5"))


@query
def skill_use(spark, sf):
    return skills.use_rows(skills.declarations(d.skill_documents(spark, sf)), "acme")


@query
def skill_warnings(spark, sf):
    return skills.warnings(skills.declarations(d.skill_documents(spark, sf)))


def _uses(spark: SparkSession, sf: str) -> DataFrame:
    return skills.use_rows(skills.declarations(d.skill_documents(spark, sf)), "acme")


def _objects(spark: SparkSession, sf: str) -> DataFrame:
    docs = d.table(spark, sf, "documents")
    return docs.select(F.col("lang").alias("schema_name"), F.col("source").alias("table_name")).distinct()


@query
def usable_skill_counts(spark, sf):
    """Skills per object, from schema grants and table grants together."""
    uses = staged(_uses(spark, sf), "uses")
    return search.usable_skill_counts(uses, _objects(spark, sf))


@query
def usable_skills(spark, sf):
    """Skill and object pairs for all objects granted by name."""
    uses = staged(_uses(spark, sf), "uses")
    return search.usable_skills(uses, search.granted_objects(uses))


@query
def skills_for_object(spark, sf):
    return search.skills_for(_uses(spark, sf), "en", "src1")


@query
def keyword_outcome(spark, sf):
    """Hits per keyword over whole skill texts; a keyword without hits is listed with zero."""
    roots = skills.root_rows(d.skill_documents(spark, sf), "acme")
    return search.keyword_outcome(roots, "root", ["the", "license", "src1/", "no_such_word_"])


@query
def metric_search(spark, sf):
    found = search.search(osi.metrics(d.osi_models(spark, sf)), "osi_metric", ["balance_1", "customer#00000012"])
    return found.select("model_name", "name", "keyword")


@query
def measure_search(spark, sf):
    """The same search over LookML and Omni measures."""
    a = search.search(lookml.measures(d.lookml_blocks(spark, sf)), "lookml_measure", ["total"])
    b = search.search(omni.measures(d.omni_views(spark, sf)), "omni_measure", ["total of 1"])
    return a.select(F.lit("lookml").alias("provider"), "view_name", "measure_name").unionByName(
        b.select(F.lit("omni").alias("provider"), "view_name", "measure_name")
    )


# --- notes ---


def _section(spark: SparkSession, sf: str, section: str) -> DataFrame:
    return notes.section_notes(notes.note_rows(d.parsed_notes(spark, sf)), section)


def _flat_notes(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "tags": _csv("tags"),
            "content": F.md5("content"),
            "created_at": _utc("created_at"),
            "updated_at": _utc("updated_at"),
        }
    )


@query
def notes_schemata(spark, sf):
    return _flat_notes(_section(spark, sf, "schema_notes"))


@query
def notes_tables(spark, sf):
    return _flat_notes(_section(spark, sf, "table_notes"))


@query
def notes_columns(spark, sf):
    return _flat_notes(_section(spark, sf, "column_notes"))


@query
def notes_violations(spark, sf):
    parsed = staged(d.parsed_notes(spark, sf, broken=True), "notes")
    return notes.contract_violations(parsed).select("file_path", "path", "rule")


@query
def notes_valid(spark, sf):
    """Quarantine: notes without a violation of their own."""
    parsed = staged(d.parsed_notes(spark, sf, broken=True), "notes")
    return notes.valid_rows(parsed).groupBy("section").agg(F.count(F.lit(1)).alias("n"))


@query
def notes_repeated_ids(spark, sf):
    return notes.duplicate_ids(d.parsed_notes(spark, sf))


def _context(spark: SparkSession, sf: str, section: str) -> DataFrame:
    table = notes.SECTIONS[section].name
    rows = staged(_section(spark, sf, section), "notes")
    keys = context.OBJECT_KEYS[table]
    found = context.context(rows, keys)
    return found.select(*keys, "note_id", "confidence", "notes_on_count", "notes_on_highest_importance")


@query
def context_schemata(spark, sf):
    return _context(spark, sf, "schema_notes")


@query
def context_tables(spark, sf):
    return _context(spark, sf, "table_notes")


@query
def context_columns(spark, sf):
    return _context(spark, sf, "column_notes")


@query
def context_sql(spark, sf):
    """The context of schemas, tables and columns read as SQL views."""
    tables = notes.family(staged(notes.note_rows(d.parsed_notes(spark, sf)), "notes"))
    context.create_context_views(tables, 3, "demo_")
    return spark.sql(
        """SELECT s.schema_name, s.notes_on_count AS schema_notes, t.highest, t.tables, c.column_notes, c.highest_of_columns
           FROM demo_notes_on_schemata_context s
           JOIN (SELECT table_schema, max(notes_on_highest_importance) AS highest, count(DISTINCT table_name) AS tables
                 FROM demo_notes_on_tables_context GROUP BY table_schema) t ON t.table_schema = s.schema_name
           JOIN (SELECT table_schema, sum(notes_on_count) AS column_notes,
                   max(notes_on_highest_importance) AS highest_of_columns
                 FROM demo_notes_on_columns_context GROUP BY table_schema) c ON c.table_schema = s.schema_name"""
    )


@query
def top_notes(spark, sf):
    top = context.top_notes(_section(spark, sf, "table_notes"), ["table_schema", "table_name"], 3)
    return top.select("table_schema", "table_name", "note_id", F.col("rank").cast("long").alias("rank"))


@query
def picked_notes(spark, sf):
    rows = context.pick_notes(_section(spark, sf, "table_notes"), kind="good", tag="en")
    return rows.select("note_id", "table_name", "kind")


@query
def enriched_tables(spark, sf):
    """Every (language, source) with its notes; objects without notes stay."""
    docs = d.table(spark, sf, "documents")
    objects = docs.select(
        F.when(F.col("doc_id") % 2 == 1, F.lit("wh")).alias("table_catalog"),
        F.col("lang").alias("table_schema"),
        F.col("source").alias("table_name"),
    ).distinct()
    keys = context.OBJECT_KEYS["notes_on_tables"]
    rows = context.enrich(objects, context.summary(_section(spark, sf, "table_notes"), keys), keys)
    return rows.select(*keys, "notes_on_count", "notes_on_highest_importance")


# --- graphs ---


@query
def key_closure(spark, sf):
    """Everything below one region, with the shortest distance."""
    reached = graph.downstream(d.key_edges(spark, sf), _nodes(spark, "region.0"))
    return reached.withColumn("depth", F.col("depth").cast("long"))


@query
def key_ancestors(spark, sf):
    """Everything above two parts."""
    reached = graph.upstream(d.key_edges(spark, sf), _nodes(spark, "part.1", "part.2"))
    return reached.withColumn("depth", F.col("depth").cast("long"))


# --- matching across sources ---


@query
def view_model_match(spark, sf):
    return search.match_views_to_models(d.reference_views(spark, sf), d.reference_models(spark, sf))


@query
def view_model_match_literal(spark, sf):
    return search.match_views_to_models(
        d.reference_views(spark, sf), d.reference_models(spark, sf), literal=True
    )


# --- table maintenance ---

ORDERS = TableSpec(
    "orders_copy",
    T.StructType(
        [
            T.StructField("o_orderkey", T.LongType(), False),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
        ]
    ),
    ("o_orderkey",),
    ("o_orderkey",),
    buckets=4,
)


def _target(spark: SparkSession, sf: str) -> DataFrame:
    return d.table(spark, sf, "orders").filter("o_orderkey % 3 <> 0").select(*ORDERS.columns)


def _source(spark: SparkSession, sf: str) -> DataFrame:
    changed = d.table(spark, sf, "orders").filter("o_orderkey % 2 = 0")
    return changed.withColumn("o_totalprice", F.col("o_totalprice") + 1).select(*ORDERS.columns)


def _catalog(spark: SparkSession) -> store.Catalog:
    return store.Catalog(spark, run_folder(spark, "catalog"))


@query
def store_insert(spark, sf):
    """Append twice: keys are not checked, so they repeat."""
    catalog = _catalog(spark)
    catalog.ensure(ORDERS)
    catalog.insert(ORDERS, _target(spark, sf))
    catalog.insert(ORDERS, _source(spark, sf))
    return catalog.read(ORDERS)


@query
def store_upsert(spark, sf):
    catalog = _catalog(spark)
    catalog.replace(ORDERS, _target(spark, sf))
    catalog.upsert(ORDERS, _source(spark, sf))
    return catalog.read(ORDERS)


@query
def store_upsert_last_wins(spark, sf):
    """Repeated keys in the change set: the highest sequence number counts."""
    lines = d.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("o_custkey"),
        F.col("l_returnflag").alias("o_orderstatus"),
        F.lit(0.0).alias("o_totalprice"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag").alias("sequence"),
    )
    catalog = _catalog(spark)
    catalog.replace(ORDERS, _target(spark, sf))
    catalog.upsert(ORDERS, lines, sequence="sequence")
    return catalog.read(ORDERS)


@query
def store_delete(spark, sf):
    catalog = _catalog(spark)
    catalog.replace(ORDERS, _target(spark, sf))
    doomed = d.table(spark, sf, "orders").filter("o_orderkey % 11 = 0")
    catalog.delete(ORDERS, ["o_orderkey"], doomed)
    return catalog.read(ORDERS)


@query
def store_reconcile(spark, sf):
    catalog = _catalog(spark)
    catalog.replace(ORDERS, _target(spark, sf))
    catalog.reconcile(ORDERS, _source(spark, sf))
    return catalog.read(ORDERS)


@query
def store_reconcile_changes(spark, sf):
    catalog = _catalog(spark)
    catalog.replace(ORDERS, _target(spark, sf))
    unchanged = d.table(spark, sf, "orders").filter("o_orderkey % 4 = 1").select(*ORDERS.columns)
    return catalog.reconcile(ORDERS, _source(spark, sf).unionByName(unchanged))


@query
def store_present_only(spark, sf):
    """Target rows whose key the source still has."""
    return store.present_only(_target(spark, sf), _source(spark, sf), ORDERS.keys)


@query
def published_family(spark, sf):
    """A family replaced and its registry rows upserted; row counts of what was published."""
    catalog = _catalog(spark)
    blocks = staged(d.lookml_blocks(spark, sf), "lookml")
    catalog.publish_family(registry.root_entries(spark, "omni"), {})
    catalog.publish_family(registry.root_entries(spark, "lookml"), lookml.family(blocks))
    names = [*lookml.family(blocks), "root"]
    return checks.row_counts({n: catalog.read(ALL_TABLES[n]) for n in names})


@query
def published_skills(spark, sf):
    """All skills of a provider, then one batch again with fewer uses; other providers stay."""
    catalog = _catalog(spark)
    docs = d.skill_documents(spark, sf)
    other = docs.filter("startswith(file_path, 'src1/')")
    declared = staged(skills.declarations(docs), "declared")
    catalog.publish_skill_batch(skills.root_rows(other, "other"), skills.use_rows(skills.declarations(other), "other"))
    catalog.publish_skills("acme", skills.root_rows(docs, "acme"), skills.use_rows(declared, "acme"))
    again = docs.filter("startswith(file_path, 'src5/')").withColumn("content", F.lit("# rewritten"))
    catalog.publish_skill_batch(skills.root_rows(again, "acme"), skills.use_rows(skills.declarations(again), "acme"))
    uses = catalog.read(SKILL_USE).groupBy("provider").agg(F.count(F.lit(1)).alias("uses"))
    roots = catalog.read(ROOT).groupBy("provider").agg(
        F.count(F.lit(1)).alias("skills"), F.count_if(F.col("content") == "# rewritten").alias("rewritten")
    )
    return roots.join(uses, "provider", "left")


@query
def semantic_pointers(spark, sf):
    """Pointers upserted next to other providers' rows, then listed."""
    catalog = _catalog(spark)
    catalog.upsert(ROOT, registry.root_entries(spark, "dbt", "lookml"))
    pointers = registry.pointer_rows(registry.semantic_view_names(d.semantic_names(spark, sf)))
    catalog.upsert(ROOT, pointers.unionByName(registry.root_entries(spark, registry.POINTER_PROVIDER)))
    return registry.pointer_listing(catalog.read(ROOT)).select("key")


@query
def semantic_pointers_sql(spark, sf):
    """The same listing as SQL over a view of the published registry."""
    catalog = _catalog(spark)
    pointers = registry.pointer_rows(registry.semantic_view_names(d.semantic_names(spark, sf)))
    catalog.publish_family(pointers.unionByName(registry.root_entries(spark, registry.POINTER_PROVIDER)), {})
    catalog.create_views("pointer_demo_")
    return spark.sql(
        "SELECT key, substring_index(content, '\n', 1) AS title FROM pointer_demo_root "
        "WHERE provider = 'snowflake_semantic' AND key LIKE 'semantic_view/%' ORDER BY key"
    )


@query
def root_listing(spark, sf):
    """The whole registry in order, with a provider gate on top."""
    pointers = registry.pointer_rows(registry.semantic_view_names(d.semantic_names(spark, sf)))
    roots = registry.root_entries(spark, "dbt").unionByName(pointers)
    uses = spark.createDataFrame([("dbt",), ("omni",), (registry.POINTER_PROVIDER,)], "provider string")
    present = registry.present_families(roots, uses)
    return registry.listing(roots.join(present, "provider", "left_semi")).select("provider", "key")


@query
def refreshed_stream(spark, sf):
    """Two drops of files, each taken in by an available-now run over one checkpoint."""
    folder, state = run_folder(spark, "drops"), run_folder(spark, "stream")
    catalog = _catalog(spark)
    docs = d.lookml_documents(spark, sf)
    early = F.pmod(F.xxhash64("file_path"), F.lit(2)) == 0
    for n, drop in enumerate([docs.filter(early), docs.filter(~early)]):
        drop.select("content").write.option("maxRecordsPerFile", 20).text(f"{folder}/drop{n}")
        stream = document_stream(spark, folder, ".txt")
        refresh_lookml_stream(stream, catalog, state).awaitTermination()
    return catalog.read(LOOKML_VIEW).select("name", "label", "sql_table_name")


def _put(spark: SparkSession, path: str, text: str | None) -> None:
    """Write one small file in place, or delete it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if text is None:
        files.delete(target, False)
        return
    stream = files.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


@query
def refreshed_files(spark, sf):
    """LookML files taken in, then four of them edited, deleted, broken and taken away from under another one that they redefined."""
    folder, catalog = run_folder(spark, "project"), _catalog(spark)
    docs = d.lookml_documents(spark, sf)
    named = docs.select(F.regexp_extract("file_path", r"b(\d+)\.", 1).cast("int").alias("block"), "content")
    named.write.partitionBy("block").text(folder)
    few = {r["block"]: r["content"] for r in named.filter("block < 4").collect()}
    again = few[3].replace("Use for", "Now for")
    _put(spark, f"{folder}/zz/again.txt", again)
    ledger.refresh_lookml_files(catalog, folder, ".txt")
    paths = {r["file_path"].split("/")[0]: r["file_path"] for r in listing(spark, folder, ".txt").filter("file_path RLIKE '^block=[0-3]/'").collect()}
    _put(spark, f"{folder}/{paths['block=0']}", re.sub(r'(label: "[^"#]*)#', r"\1no. ", few[0]).replace("view: part_1 {", "view: extra_1 {"))
    _put(spark, f"{folder}/{paths['block=1']}", None)
    _put(spark, f"{folder}/{paths['block=2']}", few[2] + "view: open {")
    _put(spark, f"{folder}/zz/again.txt", None)
    changes = ledger.refresh_lookml_files(catalog, folder, ".txt")
    counts = changes.groupBy(F.when(F.col("error").isNotNull(), "broken").otherwise(F.col("change")).alias("name")).agg(F.count("*").cast("string").alias("label"))
    views = catalog.read(LOOKML_VIEW).select("name", "label", "ai_context")
    return views.unionByName(counts.withColumn("ai_context", F.lit(None).cast("string")))


# --- checks ---


@query
def repeated_keys(spark, sf):
    return checks.repeated_keys(d.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def missing_values(spark, sf):
    """Required columns that hold nulls, here in models matched by reference."""
    models = ALL_TABLES["lookml_view"].conform(
        d.reference_models(spark, sf).select(
            F.col("schema_name").alias("name"),
            *[F.lit(None).cast("string").alias(c) for c in LOOKML_VIEW.columns[1:]],
        )
    )
    return checks.missing_values(models, LOOKML_VIEW)


@query
def broken_references(spark, sf):
    """All reference rules over all six families; edges lead to models that are not in the catalog (their nodes are tests)."""
    return checks.reference_violations(_families(spark, sf))


def _families(spark: SparkSession, sf: str, *, copied: bool = False) -> dict[str, DataFrame]:
    """The tables of all six families; each kind of document is parsed once."""
    declared = staged(skills.declarations(d.skill_documents(spark, sf)), "declarations")
    return {
        **manifest.family(staged(d.manifest_nodes(spark, sf), "nodes")),
        **lookml.family(staged(d.lookml_blocks(spark, sf, copied=copied), "blocks")),
        **omni.family(
            staged(parse_yaml(d.omni_view_documents(spark, sf)), "omni-views"),
            staged(parse_yaml(d.omni_topic_documents(spark, sf), tree="joins"), "omni-topics"),
        ),
        **osi.family(staged(d.osi_models(spark, sf), "models")),
        "root": skills.root_rows(d.skill_documents(spark, sf), "acme"),
        "skill_use": skills.use_rows(declared, "acme"),
        **notes.family(staged(notes.note_rows(d.parsed_notes(spark, sf)), "notes")),
    }


@query
def family_key_violations(spark, sf):
    """Repeated keys over all six families, where the LookML files of a fork repeat those of the project."""
    return checks.key_violations(_families(spark, sf, copied=True))


@query
def table_counts(spark, sf):
    nodes = staged(d.manifest_nodes(spark, sf), "nodes")
    return checks.row_counts(manifest.family(nodes))
