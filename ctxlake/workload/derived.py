"""Source documents rendered from the given tables.

Every builder is a DataFrame plan over the tables, one row per document with
``(file_path, content)``. A document covers a fixed number of rows of a primary
key, so documents stay small and their number grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import lookml, manifest, omni, osi
from ..runtime import staged
from ..sources.lookml import parse_lookml
from ..sources.manifest import manifests_from_text
from ..sources.yamldoc import parse_yaml


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(key: Column, text: Column, sep: str) -> Column:
    """Texts of one block in key order."""
    ordered = F.array_sort(F.collect_list(F.struct(key.alias("k"), text.alias("t"))))
    return F.array_join(F.transform(ordered, lambda e: e["t"]), sep)


def _json(value: Column) -> Column:
    """A string as a JSON (and YAML) double-quoted scalar."""
    text = F.to_json(F.array(value))
    return F.substring(text, F.lit(2), F.length(text) - 2)


# --- manifests: one per 50 customers ---


def manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    id_of = lambda key: F.concat(F.lit("model.shop.c"), key.cast("string"))
    column = lambda kind, text: F.struct(
        F.lit(kind).cast("string").alias("data_type"), F.lit(text).cast("string").alias("description")
    )
    schema = F.lower("c_mktsegment")
    depends = F.array_compact(
        F.array(
            F.when(k > 0, id_of(F.floor(k / 2))),
            F.concat(F.lit("source.raw.n"), F.col("c_nationkey").cast("string")),
            F.when(k % 7 == 0, F.concat(F.lit("raw"), k.cast("string"))),
        )
    )
    node = F.struct(
        F.when(k % 5 == 0, F.lit("test")).otherwise(F.lit("model")).alias("resource_type"),
        F.col("c_name").alias("name"),
        F.lit("wh").alias("database"),
        schema.alias("schema"),
        F.when(k % 3 != 0, F.concat(F.lit("Customer "), "c_name")).alias("description"),
        F.concat(F.lit("models/"), schema, F.lit("/c"), k.cast("string"), F.lit(".sql")).alias(
            "original_file_path"
        ),
        F.struct(
            F.when(k % 2 == 1, F.lit("view")).otherwise(F.lit("table")).alias("materialized"),
            F.when(k % 4 == 0, F.struct(F.concat(F.lit("o"), k.cast("string")).alias("owner"))).alias("meta"),
        ).alias("config"),
        F.when(k % 4 == 1, F.struct((k % 7).alias("tier"))).alias("meta"),
        F.when(k % 6 != 0, F.array(F.lit("seg"), F.col("c_mktsegment"))).alias("tags"),
        F.create_map(
            F.lit("c_custkey"), column("bigint", "key"),
            F.lit("c_acctbal"), column("double", None),
            F.lit("note"), column(None, None),
        ).alias("columns"),
        F.struct(depends.alias("nodes")).alias("depends_on"),
    )
    customers = table(spark, sf_dir, "customer")
    return (
        customers.select(F.floor(k / 50).alias("block"), id_of(k).alias("uid"), node.alias("node"))
        .groupBy("block")
        .agg(F.map_from_entries(F.collect_list(F.struct("uid", "node"))).alias("nodes"))
        .select(
            F.concat(F.lit("p"), F.col("block").cast("string"), F.lit("/target/manifest.json")).alias("file_path"),
            F.to_json(F.struct("nodes")).alias("content"),
        )
    )


def manifest_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.model_nodes(manifests_from_text(manifest_documents(spark, sf_dir)))


# --- LookML: one file per 50 parts ---

_VIEW_TEXT = """view: part_%1$d {
  # it's an "odd" comment {
  sql_table_name: shop.part_%1$d ;;
  label: "%2$s #%1$d"
%3$s  ai_context: 'Use for %4$s'
  dimension: p_partkey {
    primary_key: yes
    type: number
    sql: ${TABLE}.p_partkey ;;
  }
  dimension: price { type: number sql: ${TABLE}.p_retailprice ;; }
  dimension: net_price {
    type: number
    sql: {%% if p_size._in_query %%} 0 {%% else %%} ${price} * 2 {%% endif %%} ;;
  }
  dimension_group: created {
    type: time
    timeframes: [date, month]
    sql: ${TABLE}.created_at ;;
  }
  measure: total_price {
    type: sum
    sql:
      ${%5$s}
    ;;
    description: "Total price"
%6$s  }
  measure: n { type: count }
}
explore: %7$s_%1$d {
%8$s  label: "Explore %1$d"
  join: other { from: zzz label: "no" }
}
"""


def lookml_documents(spark: SparkSession, sf_dir: str, *, broken: bool = False) -> DataFrame:
    """``broken`` drops the last brace of every third file."""
    k = F.col("p_partkey")
    text = F.format_string(
        _VIEW_TEXT,
        k,
        F.col("p_name"),
        F.when(k % 3 == 0, F.lit("")).otherwise(
            F.format_string('  description: "Size %d, brand %s"\n', F.col("p_size"), F.col("p_brand"))
        ),
        F.col("p_type"),
        F.when(k % 4 == 0, F.lit("net_price")).otherwise(F.lit("price")),
        F.when(k % 2 == 0, F.format_string('    filters: [p_brand: "%s"]\n', F.col("p_brand"))).otherwise(
            F.lit("")
        ),
        F.when(k % 3 == 0, F.lit("exp")).otherwise(F.lit("part")),
        F.when(k % 3 == 0, F.format_string("  from: part_%d\n", k)).otherwise(F.lit("")),
    )
    block = F.floor(k / 50)
    files = table(spark, sf_dir, "part").groupBy(block.alias("block")).agg(_joined(k, text, "").alias("content"))
    content = F.col("content")
    if broken:
        content = F.when(F.col("block") % 3 == 0, F.regexp_replace(content, r"\}\s*\z", "")).otherwise(content)
    return files.select(
        F.format_string("models/b%d.view.lkml", F.col("block")).alias("file_path"), content.alias("content")
    )


def lookml_blocks(spark: SparkSession, sf_dir: str, *, copied: bool = False) -> DataFrame:
    """``copied`` has every file a second time under another folder, as a project and its fork."""
    docs = lookml_documents(spark, sf_dir)
    if copied:
        docs = docs.unionByName(docs.withColumn("file_path", F.concat(F.lit("fork/"), "file_path")))
    return parse_lookml(docs)


# --- Omni: one view per part, one topic per 20 customers ---

_OMNI_VIEW = """%1$sschema: shop
table_name: PART_%2$d
label: %3$s
dimensions:
  p_partkey:
    sql: '"P_PARTKEY"'
    format: ID
    primary_key: true
    description: Key of %2$d
  p_name:
    sql: '"P_NAME"'
    label: "Name: %4$s"
  odd:
measures:
  count:
    aggregate_type: count
  total_price:
    aggregate_type: sum
    sql: '"P_RETAILPRICE"'
    description: Total of %2$d
%5$s"""


def omni_view_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th document is not readable YAML."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.format_string("%s/part_%d.view.yaml", F.lower("p_type"), k).alias("file_path"),
        F.format_string(
            _OMNI_VIEW,
            F.when(k % 2 == 0, F.format_string("# Reference this view as shop__p%d\n", k)).otherwise(F.lit("")),
            k,
            _json(F.col("p_name")),
            F.col("p_brand"),
            F.when(k % 97 == 0, F.lit("bad: [unclosed\n")).otherwise(F.lit("")),
        ).alias("content"),
    )


def omni_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omni.view_documents(parse_yaml(omni_view_documents(spark, sf_dir)))


def omni_topic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join tree base view → segment → nation → customer → calendar, calendar also below nation."""
    leaf = F.create_map(F.lit("calendar"), F.lit(""))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    customers = table(spark, sf_dir, "customer").select(
        F.floor(F.col("c_custkey") / 20).alias("block"),
        F.concat(F.lit("seg_"), F.lower("c_mktsegment")).alias("segment"),
        F.format_string("n_%d", F.col("c_nationkey")).alias("nation"),
        F.format_string("c_%d", F.col("c_custkey")).alias("customer"),
    )
    entry = lambda name, value: F.struct(name.alias("k"), value.alias("v"))
    nations = customers.groupBy("block", "segment", "nation").agg(
        F.map_from_entries(
            F.concat(
                F.collect_list(entry(F.col("customer"), leaf)), F.array(entry(F.lit("calendar"), none))
            )
        ).alias("tree")
    )
    segments = nations.groupBy("block", "segment").agg(
        F.map_from_entries(F.collect_list(entry(F.col("nation"), F.col("tree")))).alias("tree")
    )
    topics = segments.groupBy("block").agg(
        F.map_from_entries(F.collect_list(entry(F.col("segment"), F.col("tree")))).alias("joins")
    )
    b = F.col("block")
    doc = F.struct(
        F.format_string("blk_%d", b).alias("base_view"),
        F.format_string("Topic %d", b).alias("label"),
        F.when(b % 3 == 0, F.lit("Group")).alias("group_label"),
        F.lit("Customers by segment").alias("description"),
        F.when(b % 2 == 0, F.format_string("Use for block %d", b)).alias("ai_context"),
        F.col("joins"),
    )
    return topics.select(
        F.format_string("topics/t%d.topic.yaml", b).alias("file_path"), F.to_json(doc).alias("content")
    )


def omni_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omni.topic_documents(parse_yaml(omni_topic_documents(spark, sf_dir), tree="joins"))


# --- OSI: one model per 20 customers ---


def osi_documents(spark: SparkSession, sf_dir: str, *, broken: bool = False) -> DataFrame:
    """``broken``: by document number modulo 4 a dataset without source, a wrong
    version, an unknown dialect with an unknown field, or nothing wrong."""
    k, b = F.col("c_custkey"), F.floor(F.col("c_custkey") / 20)
    n = k.cast("string")
    no_source = F.lit(broken) & (b % 4 == 0) & (k % 20 == 1)
    odd_metric = F.lit(broken) & (b % 4 == 2) & (k % 20 == 3)
    source = F.concat(F.lit("wh."), F.lower("c_mktsegment"), F.lit("."), "c_name")
    join = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    dataset = join(
        '{"name":"c_', n, '"',
        F.when(no_source, F.lit("")).otherwise(join(',"source":', _json(source))),
        ',"primary_key":["id"]',
        F.when(k % 2 == 0, F.lit(',"unique_keys":[["id"],["a","b"]]')).otherwise(F.lit("")),
        F.when(k % 3 != 0, join(',"description":"Customer ', n, '"')).otherwise(F.lit("")),
        F.when(k % 3 == 0, join(',"ai_context":"plain ', n, '"'))
        .when(k % 3 == 1, join(',"ai_context":{"synonyms":["s', n, '","t"],"instructions":"i"}'))
        .otherwise(F.lit("")),
        ',"fields":[{"name":"id","expression":{"dialects":[{"dialect":"ANSI_SQL","expression":"id"}]}},'
        '{"name":"opened","label":"Opened","dimension":{"is_time":true},"expression":{"dialects":'
        '[{"dialect":"ANSI_SQL","expression":"opened_at"},{"dialect":"DATABRICKS","expression":"date(opened_at)"}]}}]',
        F.when(
            k % 5 == 0, F.lit(',"custom_extensions":[{"vendor_name":"DBT","data":"{}"}]')
        ).otherwise(F.lit("")),
        "}",
    )
    metric = join(
        '{"name":"balance_', n, '","description":"Balance of ', F.col("c_name"),
        '","expression":{"dialects":[{"dialect":"',
        F.when(odd_metric, F.lit("SPARK")).otherwise(F.lit("ANSI_SQL")),
        '","expression":"SUM(c_', n, '.amount)"}',
        F.when(k % 2 == 1, join(',{"dialect":"SNOWFLAKE","expression":"SUM(c_', n, '.amt)"}')).otherwise(F.lit("")),
        "]}",
        F.when(odd_metric, F.lit(',"extra":1')).otherwise(F.lit("")),
        "}",
    )
    parent = (b * 20 + F.floor((k % 20) / 2)).cast("string")
    relationship = F.when(
        k % 20 != 0,
        join(
            '{"name":"r_', n, '","from":"c_', n, '","to":"c_', parent,
            '","from_columns":["parent"],"to_columns":["id"]}',
        ),
    )
    files = table(spark, sf_dir, "customer").groupBy(b.alias("block")).agg(
        _joined(k, dataset, ",").alias("datasets"),
        _joined(k, metric, ",").alias("metrics"),
        F.array_join(F.sort_array(F.collect_list(relationship)), ",").alias("relationships"),
    )
    b = F.col("block")
    version = F.when(F.lit(broken) & (b % 4 == 1), F.lit("9.9")).otherwise(F.lit("0.2.0.dev0"))
    content = join(
        '{"version":"', version, '","semantic_model":[{"name":"model_', b.cast("string"), '"',
        F.when(b % 2 == 0, F.lit(',"description":"Even"')).otherwise(F.lit("")),
        ',"datasets":[', F.col("datasets"), '],"metrics":[', F.col("metrics"),
        '],"relationships":[', F.col("relationships"), "]}]}",
    )
    return files.select(F.format_string("m%d.osi.yaml", b).alias("file_path"), content.alias("content"))


def osi_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return osi.model_rows(parse_yaml(osi_documents(spark, sf_dir)))


# --- a governed model over the order tables ---

SHOP_MODEL = """
version: "0.2.0.dev0"
semantic_model:
  - name: shop
    description: Orders, line items and the parties to them
    ai_context:
      synonyms: [sales model]
      instructions: Use revenue for any question about sales.
    datasets:
      - name: lineitem
        source: shop.lineitem
        primary_key: [l_orderkey, l_linenumber]
        fields:
          - name: l_shipdate
            expression: {dialects: [{dialect: ANSI_SQL, expression: l_shipdate}]}
            dimension: {is_time: true}
          - name: net_price
            expression:
              dialects:
                - {dialect: ANSI_SQL, expression: "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(24,4))"}
      - name: orders
        source: shop.orders
        primary_key: [o_orderkey]
        fields:
          - name: o_orderdate
            expression: {dialects: [{dialect: ANSI_SQL, expression: o_orderdate}]}
            dimension: {is_time: true}
      - name: customer
        source: shop.customer
        primary_key: [c_custkey]
        fields:
          - name: display_name
            expression:
              dialects:
                - {dialect: ANSI_SQL, expression: "c_name || ' ' || c_mktsegment"}
      - name: part
        source: shop.part
        primary_key: [p_partkey]
      - name: supplier
        source: shop.supplier
        primary_key: [s_suppkey]
        fields:
          - name: balance
            expression: {dialects: [{dialect: ANSI_SQL, expression: "CAST(s_acctbal AS DECIMAL(20,2))"}]}
    relationships:
      - {name: lineitem_to_orders, from: lineitem, to: orders, from_columns: [l_orderkey], to_columns: [o_orderkey]}
      - {name: orders_to_customer, from: orders, to: customer, from_columns: [o_custkey], to_columns: [c_custkey]}
      - {name: lineitem_to_part, from: lineitem, to: part, from_columns: [l_partkey], to_columns: [p_partkey]}
      - {name: lineitem_to_supplier, from: lineitem, to: supplier, from_columns: [l_suppkey], to_columns: [s_suppkey]}
    metrics:
      - name: revenue
        description: Price after discount
        expression: {dialects: [{dialect: ANSI_SQL, expression: SUM(lineitem.net_price)}]}
      - name: revenue_per_customer
        description: Revenue per buying customer
        expression:
          dialects:
            - dialect: ANSI_SQL
              expression: CAST(SUM(lineitem.net_price) AS DOUBLE) / COUNT(DISTINCT customer.c_custkey)
      - name: revenue_to_balance
        description: Revenue over supplier balance
        expression:
          dialects:
            - dialect: ANSI_SQL
              expression: CAST(SUM(lineitem.net_price) AS DOUBLE) / NULLIF(SUM(supplier.balance), 0)
      - name: order_count
        expression: {dialects: [{dialect: ANSI_SQL, expression: COUNT(DISTINCT orders.o_orderkey)}]}
      - name: returned_share
        expression:
          dialects:
            - dialect: ANSI_SQL
              expression: SUM(CASE WHEN lineitem.l_returnflag = 'R' THEN 1 ELSE 0 END) / COUNT(*)
"""


def shop_tables(spark: SparkSession) -> dict[str, DataFrame]:
    docs = spark.createDataFrame([("shop.osi.yaml", SHOP_MODEL)], "file_path string, content string")
    rows = staged(osi.model_rows(parse_yaml(docs)), "shop")
    return {**osi.family(rows), "osi_field": osi.fields(rows, with_model=True)}


def shop_reader(spark: SparkSession, sf_dir: str):
    return lambda source: table(spark, sf_dir, source.split(".")[-1])


# --- skills: one Markdown file per document ---


def skill_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    head = (
        F.when(
            d % 4 == 1,
            F.format_string(
                "---\nuses:\n  schemas:\n    - %1$s\n  tables:\n    - %1$s.%2$s\n    - shop.t%3$d\n---\n",
                "lang", "source", d,
            ),
        )
        .when(d % 4 == 2, F.format_string("---\nuses:\n  tables:\n    - %s\n---\n", "source"))
        .when(d % 4 == 3, F.format_string("---\nuses:\n  schemas: [%s]\n", "lang"))
        .otherwise(F.lit(""))
    )
    return table(spark, sf_dir, "documents").select(
        F.format_string("%s/d%d.md", "source", d).alias("file_path"), F.concat(head, "text").alias("content")
    )


# --- notes: one file per 25 documents ---


def note_documents(spark: SparkSession, sf_dir: str, *, broken: bool = False) -> DataFrame:
    """Three notes per document. ``broken`` adds one fault by document id."""
    d = F.col("doc_id")
    n = d.cast("string")
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    importance = F.when(F.lit(broken) & (d % 7 == 0), F.lit(2.0)).otherwise(
        (F.col("n_chars") % 101) / F.lit(100.0)
    )
    kind = F.when(F.col("quality").isNull(), F.lit("unrated")).when(F.col("quality") == 1, F.lit("good")).otherwise(F.lit("poor"))
    common = [
        F.when(F.lit(broken) & (d % 13 == 0), F.lit("")).otherwise(kind).alias("kind"),
        F.array("source", "lang").alias("tags"),
        F.format_string("Doc %d", d).alias("title"),
        F.col("text").alias("content"),
        F.format_string("a%d", d % 5).alias("author"),
        F.col("source").alias("source"),
        F.when(d % 3 != 0, (d % 10) / F.lit(10.0)).alias("confidence"),
        importance.alias("importance"),
        F.format_string("2024-01-%02dT00:00:00Z", (d % 28) + 1).alias("created_at"),
    ]
    extra = F.when(F.lit(broken) & (d % 17 == 0), F.lit("x")).alias("extra")
    catalog = F.when(d % 2 == 1, F.lit("wh")).alias("table_catalog")
    place = [catalog, F.col("lang").alias("table_schema"), F.col("source").alias("table_name")]
    column_id = F.when(d % 50 == 0, F.concat(F.lit("s"), n)).otherwise(F.concat(F.lit("c"), n))
    notes = docs.select(
        F.floor(d / 25).alias("block"),
        d.alias("d"),
        F.struct(
            F.concat(F.lit("s"), n).alias("note_id"), F.col("lang").alias("schema_name"), *common, extra
        ).alias("s"),
        F.struct(F.concat(F.lit("t"), n).alias("note_id"), *place, *common).alias("t"),
        F.struct(column_id.alias("note_id"), *place, F.lit("text").alias("column_name"), *common).alias("c"),
    )
    files = notes.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("d", "s", "t", "c"))).alias("n"))
    doc = F.struct(
        F.transform("n", lambda x: x["s"]).alias("schema_notes"),
        F.transform("n", lambda x: x["t"]).alias("table_notes"),
        F.transform("n", lambda x: x["c"]).alias("column_notes"),
    )
    return files.select(
        F.format_string("notes/b%d.yml", F.col("block")).alias("file_path"), F.to_json(doc).alias("content")
    )


def parsed_notes(spark: SparkSession, sf_dir: str, *, broken: bool = False) -> DataFrame:
    return parse_yaml(note_documents(spark, sf_dir, broken=broken), tag_dates=True)


# --- a deep graph over the keys of the order tables ---


def key_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region → nation → customer → order → part; parts are reached over many orders."""
    t = lambda name: table(spark, sf_dir, name)

    def edge(frame, above, above_key, below, below_key):
        return frame.select(
            F.concat(F.lit(f"{above}."), F.col(above_key).cast("string")).alias("upstream_id"),
            F.concat(F.lit(f"{below}."), F.col(below_key).cast("string")).alias("downstream_id"),
        )

    return (
        edge(t("nation"), "region", "n_regionkey", "nation", "n_nationkey")
        .unionByName(edge(t("customer"), "nation", "c_nationkey", "customer", "c_custkey"))
        .unionByName(edge(t("orders"), "customer", "o_custkey", "order", "o_orderkey"))
        .unionByName(edge(t("lineitem"), "order", "l_orderkey", "part", "l_partkey"))
    )


# --- free-form references and the models they name ---


def reference_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.format_string("v_%d", k).alias("name"),
        F.concat(
            F.format_string('"wh".Mart_%d.%s_%d', k % 7, F.replace("p_name", F.lit(" "), F.lit("_")), k),
            F.when(k % 3 == 0, F.lit("_v AS x")).otherwise(F.lit("")),
        ).alias("sql_table_name"),
    )


def reference_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some without schema, some with ``%`` in the name; short names are prefixes of longer ones."""
    k = F.col("p_partkey")
    name = F.format_string("%s_%d", F.replace("p_name", F.lit(" "), F.lit("_")), k)
    return table(spark, sf_dir, "part").select(
        F.format_string("model.p%d", k).alias("unique_id"),
        F.when(k % 41 == 0, F.replace(name, F.lit("_"), F.lit("%"))).otherwise(name).alias("name"),
        F.when(k % 50 != 0, F.format_string("mart_%d", k % 7)).alias("schema_name"),
        F.col("p_type").alias("description"),
    )


def semantic_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    name = F.format_string("WH.S%d.%s", F.col("s_nationkey"), F.col("s_name"))
    padded = s.filter("s_suppkey % 2 = 0").select(F.concat(F.lit(" "), name, F.lit("  ")).alias("name"))
    return s.select(name.alias("name")).unionByName(padded)
