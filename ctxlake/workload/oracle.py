"""The same results in plain SQL, computed straight from the given tables."""

from __future__ import annotations

_DBT = """
  SELECT 'model.shop.c' || c_custkey AS unique_id, c_name AS name, 'wh' AS database_name,
    lower(c_mktsegment) AS schema_name,
    CASE WHEN c_custkey % 2 = 1 THEN 'view' ELSE 'table' END AS materialization,
    CASE WHEN c_custkey % 3 <> 0 THEN 'Customer ' || c_name ELSE '' END AS description,
    'models/' || lower(c_mktsegment) || '/c' || c_custkey || '.sql' AS file_path,
    CASE WHEN c_custkey % 6 <> 0 THEN array_to_string(list_sort(['seg', c_mktsegment]), ',') ELSE '' END AS tags,
    CASE WHEN c_custkey % 4 = 0 THEN 'o' || c_custkey END AS owner,
    CASE WHEN c_custkey % 4 = 1 THEN CAST(c_custkey % 7 AS VARCHAR) END AS tier
  FROM customer WHERE c_custkey % 5 <> 0
"""
_EDGES = """
  SELECT 'model.shop.c' || (c_custkey // 2) AS upstream_id, 'model.shop.c' || c_custkey AS downstream_id,
    'model' AS upstream_type, 'model' AS downstream_type
  FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey > 0
  UNION ALL
  SELECT 'source.raw.n' || c_nationkey, 'model.shop.c' || c_custkey, 'source', 'model'
  FROM customer WHERE c_custkey % 5 <> 0
  UNION ALL
  SELECT 'raw' || c_custkey, 'model.shop.c' || c_custkey, 'unknown', 'model'
  FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 = 0
"""
_LOOKML_VIEW = """
  SELECT 'part_' || p_partkey AS name, 'shop.part_' || p_partkey AS sql_table_name,
    p_name || ' #' || p_partkey AS label,
    CASE WHEN p_partkey % 3 <> 0 THEN 'Size ' || p_size || ', brand ' || p_brand END AS description,
    'Use for ' || p_type AS ai_context
"""
_KEY_EDGES = """
  SELECT 'region.' || n_regionkey AS u, 'nation.' || n_nationkey AS d FROM nation
  UNION SELECT 'nation.' || c_nationkey, 'customer.' || c_custkey FROM customer
  UNION SELECT 'customer.' || o_custkey, 'order.' || o_orderkey FROM orders
  UNION SELECT 'order.' || l_orderkey, 'part.' || l_partkey FROM lineitem
"""
_TOPIC = """
  SELECT c_custkey // 20 AS b, 'seg_' || lower(c_mktsegment) AS s, 'n_' || c_nationkey AS n,
    'c_' || c_custkey AS c FROM customer
"""
_STAR = """
  FROM lineitem l LEFT JOIN orders o ON l_orderkey = o_orderkey LEFT JOIN customer c ON o_custkey = c_custkey
  LEFT JOIN part p ON l_partkey = p_partkey LEFT JOIN supplier s ON l_suppkey = s_suppkey
"""
_NET = "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(24,4))"
_BALANCE = "CAST(s_acctbal AS DECIMAL(20,2))"
_NOTES = """
  SELECT doc_id AS d, CASE WHEN quality IS NULL THEN 'unrated' WHEN quality = 1 THEN 'good' ELSE 'poor' END AS kind,
    array_to_string(list_sort([source, lang]), ',') AS tags, 'Doc ' || doc_id AS title, text,
    'a' || (doc_id % 5) AS author, source, lang,
    CASE WHEN doc_id % 3 <> 0 THEN (doc_id % 10) / 10.0::DOUBLE END AS confidence,
    (n_chars % 101) / 100.0::DOUBLE AS importance,
    '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || ' 00:00:00' AS created_at,
    CASE WHEN doc_id % 2 = 1 THEN 'wh' END AS table_catalog
  FROM documents LEFT JOIN labels USING (doc_id)
"""
_NOTE_TAIL = (
    "kind, tags, title, md5(text) AS content, author, source, confidence, importance, created_at, "
    "CAST(NULL AS VARCHAR) AS updated_at"
)
_USES = """
  SELECT 'acme' AS provider, 'skill/' || source || '/d' || doc_id AS skill_key, 'schema' AS use_kind,
    lang AS object_ref FROM documents WHERE doc_id % 4 = 1
  UNION ALL
  SELECT 'acme', 'skill/' || source || '/d' || doc_id, 'table', lang || '.' || source
  FROM documents WHERE doc_id % 4 = 1
  UNION ALL
  SELECT 'acme', 'skill/' || source || '/d' || doc_id, 'table', 'shop.t' || doc_id
  FROM documents WHERE doc_id % 4 = 1
"""
_SKILLS = """
  SELECT 'acme' AS provider, 'skill/' || source || '/d' || doc_id AS key, source, doc_id, lang,
    CASE doc_id % 4
      WHEN 1 THEN '---' || chr(10) || 'uses:' || chr(10) || '  schemas:' || chr(10) || '    - ' || lang || chr(10)
        || '  tables:' || chr(10) || '    - ' || lang || '.' || source || chr(10) || '    - shop.t' || doc_id
        || chr(10) || '---' || chr(10)
      WHEN 2 THEN '---' || chr(10) || 'uses:' || chr(10) || '  tables:' || chr(10) || '    - ' || source || chr(10)
        || '---' || chr(10)
      WHEN 3 THEN '---' || chr(10) || 'uses:' || chr(10) || '  schemas: [' || lang || ']' || chr(10)
      ELSE '' END || text AS content
  FROM documents
"""
_OMNI_NAME = "CASE WHEN p_partkey % 2 = 0 THEN 'shop__p' ELSE lower(p_type) || '__part_' END || p_partkey"
_OMNI = f"SELECT {_OMNI_NAME} AS view_name, p_partkey AS k, p_name, p_brand, p_type FROM part WHERE p_partkey % 97 <> 0"
_REFS = """
  SELECT 'v_' || p_partkey AS name,
    '"wh".Mart_' || (p_partkey % 7) || '.' || replace(p_name, ' ', '_') || '_' || p_partkey
      || CASE WHEN p_partkey % 3 = 0 THEN '_v AS x' ELSE '' END AS sql_table_name
  FROM part
"""
_MODELS = """
  SELECT 'model.p' || p_partkey AS unique_id,
    CASE WHEN p_partkey % 41 = 0 THEN replace(replace(p_name, ' ', '_') || '_' || p_partkey, '_', '%')
      ELSE replace(p_name, ' ', '_') || '_' || p_partkey END AS name,
    CASE WHEN p_partkey % 50 <> 0 THEN 'mart_' || (p_partkey % 7) END AS schema_name, p_type AS description
  FROM part
"""
_TARGET = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0"
_SOURCE = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0"


def _match(condition: str) -> str:
    return f"""
      WITH v AS ({_REFS}), m AS ({_MODELS})
      SELECT v.name AS lookml_view, v.sql_table_name, m.unique_id AS dbt_model_id, m.name AS dbt_model,
        m.schema_name, m.description AS dbt_description
      FROM v LEFT JOIN m ON {condition}
    """


def _context(keys: str, row: str) -> str:
    columns = ", ".join(k.strip() for k in keys.split(","))
    same = " AND ".join(f"n.{k.strip()} IS NOT DISTINCT FROM g.{k.strip()}" for k in keys.split(","))
    return f"""
      WITH n AS (SELECT *, {row} FROM ({_NOTES})),
      g AS (SELECT {columns}, count(*) AS c, max(importance) AS h FROM n GROUP BY {columns})
      SELECT {", ".join(f"n.{k.strip()}" for k in keys.split(","))}, n.note_id, n.confidence, g.c AS notes_on_count,
        g.h AS notes_on_highest_importance
      FROM n JOIN g ON {same}
    """


ORACLE: dict[str, str] = {
    "dbt_model": _DBT,
    "manifest_files": _DBT,
    "dbt_column": """
      SELECT 'model.shop.c' || c_custkey AS model_id, x.column_name, x.data_type, x.description
      FROM customer, (VALUES ('c_custkey', 'bigint', 'key'), ('c_acctbal', 'double', ''), ('note', '', ''))
        AS x(column_name, data_type, description)
      WHERE c_custkey % 5 <> 0
    """,
    "dbt_dependency": _EDGES,
    "dbt_lineage": f"""
      WITH RECURSIVE e AS ({_EDGES}), m AS ({_DBT}),
      lineage AS (
        SELECT downstream_id AS node_id FROM e WHERE upstream_id = 'source.raw.n7'
        UNION
        SELECT e.downstream_id FROM e JOIN lineage l ON e.upstream_id = l.node_id)
      SELECT DISTINCT m.name, m.schema_name, m.description FROM lineage JOIN m ON m.unique_id = lineage.node_id
    """,
    "lookml_view": f"{_LOOKML_VIEW}, 'models/b' || (p_partkey // 50) || '.view.lkml' AS file_path FROM part",
    "lookml_files": f"{_LOOKML_VIEW} FROM part",
    "lookml_dimension": """
      SELECT 'part_' || p_partkey AS view_name, x.field_name, x.field_kind, x.type, x.sql,
        CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS ai_context, x.pk AS primary_key
      FROM part, (VALUES
        ('p_partkey', 'dimension', 'number', '${TABLE}.p_partkey', true),
        ('price', 'dimension', 'number', '${TABLE}.p_retailprice', false),
        ('net_price', 'dimension', 'number',
          '{% if p_size._in_query %} 0 {% else %} ${price} * 2 {% endif %}', false),
        ('created', 'dimension_group', 'time', '${TABLE}.created_at', false))
        AS x(field_name, field_kind, type, sql, pk)
    """,
    "lookml_measure": """
      SELECT 'part_' || p_partkey AS view_name, 'total_price' AS measure_name, 'sum' AS type,
        CASE WHEN p_partkey % 4 = 0 THEN '${net_price}' ELSE '${price}' END AS sql,
        'Total price' AS description, CAST(NULL AS VARCHAR) AS ai_context,
        CASE WHEN p_partkey % 2 = 0 THEN 'p_brand: "' || p_brand || '"' END AS filters
      FROM part
      UNION ALL
      SELECT 'part_' || p_partkey, 'n', 'count', NULL, NULL, NULL, NULL FROM part
    """,
    "lookml_explore": """
      SELECT CASE WHEN p_partkey % 3 = 0 THEN 'exp_' ELSE 'part_' END || p_partkey AS name,
        'part_' || p_partkey AS from_view, 'Explore ' || p_partkey AS label,
        CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS ai_context,
        'models/b' || (p_partkey // 50) || '.view.lkml' AS file_path
      FROM part
    """,
    "lookml_rejects": """
      SELECT DISTINCT 'models/b' || (p_partkey // 50) || '.view.lkml' AS file_path FROM part
      WHERE (p_partkey // 50) % 3 = 0
    """,
    "lookml_last_file_wins": """
      SELECT 'part_' || p_partkey AS name,
        CASE WHEN (p_partkey // 50) % 10 = 0 THEN 'Now for ' ELSE 'Use for ' END || p_type AS ai_context,
        CASE WHEN (p_partkey // 50) % 10 = 0 THEN 'zz/' ELSE '' END || 'models/b' || (p_partkey // 50) || '.view.lkml'
          AS file_path
      FROM part
    """,
    "lookml_formulas": """
      SELECT 'part_' || p_partkey AS view_name, 'total_price' AS name, 'ok' AS status,
        CASE WHEN p_partkey % 2 = 0 THEN 'CASE WHEN p_brand IN (''' || p_brand || ''') THEN ' ELSE '' END
          || CASE WHEN p_partkey % 4 = 0 THEN '(p_retailprice * 2)' ELSE 'p_retailprice' END
          || CASE WHEN p_partkey % 2 = 0 THEN ' END' ELSE '' END AS resolved, 'SUM(' || resolved || ')' AS formula
      FROM part
      UNION ALL SELECT 'part_' || p_partkey, 'n', 'ok', '1', 'COUNT(1)' FROM part
    """,
    "catalog_measures": f"""
      WITH l AS (
        SELECT CAST(sum({_NET}) FILTER (l_returnflag = 'R') AS DOUBLE) AS returned_net,
          CAST(count(*) FILTER (l_returnflag <> 'R' AND lower(l_linestatus) IN ('o', 'x')) AS DOUBLE) AS kept_open,
          CAST(count(*) FILTER (lower(l_linestatus) <> 'o') AS DOUBLE) AS not_open,
          CAST(count(*) FILTER ((l_quantity >= 1 AND l_quantity < 10 OR l_quantity BETWEEN 20 AND 25 OR l_quantity = 50)
            AND l_quantity <> 7) AS DOUBLE) AS some_quantities,
          CAST(count(DISTINCT CASE WHEN l_quantity > 25 AND l_returnflag <> 'R' THEN l_partkey END) AS DOUBLE) AS big_parts,
          CAST(count(*) FILTER (l_returnflag IN ('A', 'N')) AS DOUBLE) AS by_column FROM lineitem),
      c AS (
        SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(20,2))) AS DOUBLE) AS balance,
          CAST(count(*) FILTER (c_mktsegment LIKE 'BUILD%') AS DOUBLE) AS builders,
          CAST(count(*) FILTER (c_mktsegment <> 'BUILDING' AND c_mktsegment NOT LIKE '%HOLD') AS DOUBLE) AS others FROM customer),
      p AS (
        SELECT CAST(count(*) AS DOUBLE) AS parts, CAST(count(DISTINCT p_brand) AS DOUBLE) AS brands, avg(p_retailprice) AS retail FROM part),
      v AS (
        SELECT 'lines' AS view_name, * FROM (UNPIVOT l ON COLUMNS(*) INTO NAME name VALUE value)
        UNION ALL SELECT 'buyers', * FROM (UNPIVOT c ON COLUMNS(*) INTO NAME name VALUE value)
        UNION ALL SELECT 'shop__part', * FROM (UNPIVOT p ON COLUMNS(*) INTO NAME name VALUE value))
      SELECT view_name, name, 'ok' AS status, round(value, 2) AS value, CAST(NULL AS VARCHAR) AS shown FROM v
      UNION ALL SELECT 'lines', 'last_ship', 'ok', NULL, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') FROM lineitem
      UNION ALL SELECT 'lines', name, status, NULL, NULL FROM (VALUES ('recent', 'unsupported'), ('middle', 'unsupported'),
        ('lost', 'unknown'), ('astray', 'invalid')) AS x(name, status)
      UNION ALL SELECT 'shop__part', 'spread', 'unsupported', NULL, NULL
    """,
    "measure_kinds": f"""
      SELECT l_linestatus, count(*) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned_lines,
        count(*) FILTER (l_returnflag IN ('A', 'N') AND l_linestatus = 'O') AS closed_or_open,
        count(DISTINCT l_partkey) AS parts,
        CAST(sum({_NET}) AS DOUBLE) AS net_total,
        CAST(sum({_NET}) FILTER (l_returnflag = 'R') AS DOUBLE) AS net_returned,
        round(avg(l_quantity), 4) AS average_quantity,
        strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S') AS first_ship,
        strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS last_ship
      FROM lineitem GROUP BY l_linestatus
    """,
    "lookml_measure_sources": """
      SELECT 'part_' || p_partkey AS view_name, m.measure_name, 'shop.part_' || p_partkey AS sql_table_name,
        'Use for ' || p_type AS view_context
      FROM part, (VALUES ('total_price'), ('n')) AS m(measure_name)
    """,
    "omni_measure_sources": f"""
      SELECT view_name, m.measure_name, 'shop' AS schema, 'PART_' || k AS table_name,
        CAST(NULL AS VARCHAR) AS view_description, 'model.p' || k AS dbt_model_id,
        CASE WHEN k % 3 = 0 THEN p_type END AS dbt_description
      FROM ({_OMNI}), (VALUES ('count'), ('total_price')) AS m(measure_name)
    """,
    "omni_view": f"""
      SELECT view_name, 'shop' AS schema, 'PART_' || k AS table_name, p_name AS label,
        CAST(NULL AS VARCHAR) AS description, lower(p_type) || '/part_' || k || '.view.yaml' AS file_path
      FROM ({_OMNI})
    """,
    "omni_dimension": f"""
      SELECT view_name, 'p_partkey' AS field_name, CAST(NULL AS VARCHAR) AS label, '"P_PARTKEY"' AS sql,
        'ID' AS format, 'Key of ' || k AS description, true AS primary_key FROM ({_OMNI})
      UNION ALL SELECT view_name, 'p_name', 'Name: ' || p_brand, '"P_NAME"', NULL, NULL, false FROM ({_OMNI})
      UNION ALL SELECT view_name, 'odd', NULL, NULL, NULL, NULL, false FROM ({_OMNI})
    """,
    "omni_measure": f"""
      SELECT view_name, 'count' AS measure_name, CAST(NULL AS VARCHAR) AS label, 'count' AS aggregate_type,
        CAST(NULL AS VARCHAR) AS sql, CAST(NULL AS VARCHAR) AS description FROM ({_OMNI})
      UNION ALL SELECT view_name, 'total_price', NULL, 'sum', '"P_RETAILPRICE"', 'Total of ' || k FROM ({_OMNI})
    """,
    "omni_measure_formulas": f"""
      SELECT view_name, 'count' AS measure_name, 'COUNT(1)' AS formula FROM ({_OMNI})
      UNION ALL SELECT view_name, 'total_price', 'SUM(P_RETAILPRICE)' FROM ({_OMNI})
    """,
    "omni_rejects": """
      SELECT lower(p_type) || '/part_' || p_partkey || '.view.yaml' AS file_path FROM part WHERE p_partkey % 97 = 0
    """,
    "omni_topic": f"""
      SELECT DISTINCT 't' || b AS topic_name, 'blk_' || b AS base_view, 'Topic ' || b AS label,
        CASE WHEN b % 3 = 0 THEN 'Group' END AS group_label, 'Customers by segment' AS description,
        CASE WHEN b % 2 = 0 THEN 'Use for block ' || b END AS ai_context,
        'topics/t' || b || '.topic.yaml' AS file_path
      FROM ({_TOPIC})
    """,
    "omni_topic_join": f"""
      WITH t AS ({_TOPIC})
      SELECT 't' || b AS topic_name, 'blk_' || b AS from_view, s AS to_view FROM t
      UNION SELECT 't' || b, s, n FROM t
      UNION SELECT 't' || b, n, c FROM t
      UNION SELECT 't' || b, n, 'calendar' FROM t
      UNION SELECT 't' || b, c, 'calendar' FROM t
    """,
    "topic_reach": f"""
      WITH t AS ({_TOPIC})
      SELECT topic_name, view_name, min(depth) AS depth FROM (
        SELECT 't' || b AS topic_name, s AS view_name, 1::BIGINT AS depth FROM t
        UNION SELECT 't' || b, n, 2 FROM t
        UNION SELECT 't' || b, c, 3 FROM t
        UNION SELECT 't' || b, 'calendar', 3 FROM t)
      GROUP BY ALL
    """,
    "osi_model": """
      SELECT DISTINCT 'model_' || (c_custkey // 20) AS name, '0.2.0.dev0' AS version,
        CASE WHEN (c_custkey // 20) % 2 = 0 THEN 'Even' ELSE '' END AS description, '' AS synonyms
      FROM customer
    """,
    "osi_dataset": """
      SELECT 'model_' || (c_custkey // 20) AS model_name, 'c_' || c_custkey AS name,
        'wh.' || lower(c_mktsegment) || '.' || c_name AS source, 'id' AS primary_key,
        CASE WHEN c_custkey % 2 = 0 THEN 'id,a+b' ELSE '' END AS unique_keys,
        CASE WHEN c_custkey % 3 <> 0 THEN 'Customer ' || c_custkey ELSE '' END AS description,
        CASE WHEN c_custkey % 3 = 1 THEN 's' || c_custkey || ',t' ELSE '' END AS synonyms,
        CASE WHEN c_custkey % 3 = 0 THEN 'plain ' || c_custkey WHEN c_custkey % 3 = 1 THEN 'i' END AS context,
        CASE WHEN c_custkey % 5 = 0 THEN 'DBT{}' END AS extensions
      FROM customer
    """,
    "osi_field": """
      SELECT 'model_' || (c_custkey // 20) AS model_name, 'c_' || c_custkey AS dataset_name, x.name, x.label,
        x.is_time AS is_time_dimension, x.expressions
      FROM customer, (VALUES ('id', NULL, false, 'ANSI_SQL=id'),
        ('opened', 'Opened', true, 'ANSI_SQL=opened_at;DATABRICKS=date(opened_at)')) AS x(name, label, is_time, expressions)
    """,
    "osi_metric": """
      SELECT 'model_' || (c_custkey // 20) AS model_name, 'balance_' || c_custkey AS name,
        'Balance of ' || c_name AS description, 1 + c_custkey % 2 AS dialects FROM customer
    """,
    "osi_relationship": """
      SELECT 'model_' || (c_custkey // 20) AS model_name, 'r_' || c_custkey AS name,
        'c_' || c_custkey AS from_dataset, 'c_' || (c_custkey // 20 * 20 + c_custkey % 20 // 2) AS to_dataset,
        'parent' AS from_columns, 'id' AS to_columns
      FROM customer WHERE c_custkey % 20 <> 0
    """,
    "osi_violations": """
      WITH b AS (SELECT DISTINCT c_custkey // 20 AS b FROM customer),
      k AS (SELECT c_custkey // 20 AS b, c_custkey % 20 AS i FROM customer)
      SELECT 'm' || b || '.osi.yaml' AS file_path, '/version' AS path, 'enum' AS rule FROM b WHERE b % 4 = 1
      UNION ALL
      SELECT 'm' || b || '.osi.yaml', '/semantic_model/0/datasets/' || i || '/source', 'required'
      FROM k WHERE b % 4 = 0 AND i = 1
      UNION ALL
      SELECT 'm' || b || '.osi.yaml', '/semantic_model/0/metrics/' || i || '/extra', 'unknown_field'
      FROM k WHERE b % 4 = 2 AND i = 3
      UNION ALL
      SELECT 'm' || b || '.osi.yaml', '/semantic_model/0/metrics/' || i || '/expression/dialects/0/dialect', 'enum'
      FROM k WHERE b % 4 = 2 AND i = 3
    """,
    "osi_join_paths": """
      WITH RECURSIVE r AS (
        SELECT 'model_' || (c_custkey // 20) AS m, 'r_' || c_custkey AS name, 'c_' || c_custkey AS f,
          'c_' || (c_custkey // 20 * 20 + c_custkey % 20 // 2) AS t
        FROM customer WHERE c_custkey % 20 <> 0),
      p AS (
        SELECT m, f, t, 1::BIGINT AS hops, name AS path FROM r
        UNION ALL
        SELECT p.m, p.f, r.t, hops + 1, path || ',' || r.name FROM p JOIN r ON p.m = r.m AND p.t = r.f)
      SELECT m AS model_name, f AS from_dataset, t AS to_dataset, hops, path FROM p
    """,
    "metric_dialects": """
      SELECT 'model_' || (c_custkey // 20) AS model_name, 'balance_' || c_custkey AS name,
        'SUM(c_' || c_custkey || CASE WHEN c_custkey % 2 = 1 THEN '.amt)' ELSE '.amount)' END AS snowflake,
        'SUM(c_' || c_custkey || '.amount)' AS plain
      FROM customer
    """,
    "time_dimensions": """
      SELECT 'model_' || (c_custkey // 20) AS model_name, 'c_' || c_custkey AS dataset_name, 'opened' AS name,
        'date(opened_at)' AS formula FROM customer
    """,
    "metric_sources": """
      SELECT 'model_' || (c_custkey // 20) AS model_name, 'balance_' || c_custkey AS metric,
        'c_' || c_custkey AS dataset, 'wh.' || lower(c_mktsegment) || '.' || c_name AS source,
        CASE WHEN c_custkey % 3 = 0 THEN '"plain ' || c_custkey || '"'
          WHEN c_custkey % 3 = 1 THEN '{"instructions":"i","synonyms":["s' || c_custkey || '","t"]}' END
          AS dataset_context
      FROM customer
    """,
    "dataset_model_docs": f"""
      WITH m AS ({_DBT})
      SELECT 'model_' || (c_custkey // 20) AS model_name, 'c_' || c_custkey AS dataset,
        m.unique_id AS dbt_model_id, m.description AS dbt_description,
        CASE WHEN m.unique_id IS NOT NULL THEN 'double' END AS data_type
      FROM customer LEFT JOIN m ON lower(m.schema_name) = lower(c_mktsegment) AND lower(m.name) = lower(c_name)
    """,
    "revenue_by_brand": f"SELECT p_brand, CAST(sum({_NET}) AS DOUBLE) AS revenue {_STAR} GROUP BY p_brand",
    "revenue_by_customer_name": f"""
      SELECT c_name || ' ' || c_mktsegment AS display_name, CAST(sum({_NET}) AS DOUBLE) AS revenue,
        count(DISTINCT o_orderkey) AS order_count {_STAR} GROUP BY 1
    """,
    "all_metrics": f"""
      WITH w AS (
        SELECT CAST(sum({_NET}) AS DOUBLE) AS revenue, count(DISTINCT c_custkey) AS customers,
          CAST(sum({_BALANCE}) AS DOUBLE) AS balance,
          sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned, count(*) AS lines {_STAR})
      SELECT 'revenue' AS metric, round(revenue, 2) AS value FROM w
      UNION ALL SELECT 'revenue_per_customer', round(revenue / customers, 2) FROM w
      UNION ALL SELECT 'revenue_to_balance', round(revenue / nullif(balance, 0), 2) FROM w
      UNION ALL SELECT 'returned_share', round(returned / lines, 2) FROM w
      UNION ALL SELECT 'order_count', CAST(count(*) AS DOUBLE) FROM orders
    """,
    "grain_safe_ratio": f"""
      WITH f AS (SELECT p_brand, CAST(sum({_NET}) AS DOUBLE) AS revenue {_STAR} GROUP BY p_brand),
      g AS (
        SELECT p_brand, CAST(sum(bal) AS DOUBLE) AS balance
        FROM (SELECT DISTINCT p_brand, s_suppkey, {_BALANCE} AS bal {_STAR}) GROUP BY p_brand)
      SELECT f.p_brand, round(revenue / nullif(balance, 0), 4) AS ratio FROM f JOIN g USING (p_brand)
    """,
    "revenue_year_to_date": f"""
      SELECT c_mktsegment, CAST(sum({_NET}) AS DOUBLE) AS revenue, year(min(o_orderdate))::BIGINT AS year,
        strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS from_time,
        strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS to_time
      {_STAR}
      WHERE year(o_orderdate) = (SELECT coalesce(max(year(o_orderdate)) FILTER (year(o_orderdate) = 2026),
        max(year(o_orderdate))) FROM orders)
      GROUP BY c_mktsegment
    """,
    "revenue_latest_month": f"""
      SELECT CAST(sum({_NET}) AS DOUBLE) AS revenue,
        strftime(date_trunc('month', min(l_shipdate))::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS month,
        strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S') AS from_time,
        strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS to_time
      FROM lineitem
      WHERE date_trunc('month', l_shipdate) = (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem)
    """,
    "presented_metrics": f"""
      SELECT p_type, '$' || format('{{:,}}', CAST(round(sum({_NET}), 0) AS BIGINT)) AS revenue_shown,
        format('{{:.1f}}', round(100.0 * sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) / count(*), 1)) || '%'
          AS returned_share_shown,
        'SUM(lineitem.net_price)' AS revenue_formula
      {_STAR} GROUP BY p_type
    """,
    "skill_root": f"SELECT provider, key, md5(content) AS content_md5 FROM ({_SKILLS})",
    "skill_use": _USES,
    "skill_warnings": """
      SELECT 'skill/' || source || '/d' || doc_id AS skill_key,
        CASE WHEN doc_id % 4 = 2 THEN 'uses.tables has an entry without schema'
          ELSE 'frontmatter is not closed' END AS warning
      FROM documents WHERE doc_id % 4 IN (2, 3)
    """,
    "usable_skill_counts": f"""
      WITH u AS ({_USES}), o AS (SELECT DISTINCT lang, source FROM documents),
      g AS (
        SELECT o.lang, o.source, u.skill_key FROM o JOIN u ON u.use_kind = 'schema' AND u.object_ref = o.lang
        UNION
        SELECT o.lang, o.source, u.skill_key FROM o JOIN u
          ON u.use_kind = 'table' AND u.object_ref = o.lang || '.' || o.source)
      SELECT o.lang AS schema_name, o.source AS table_name, count(g.skill_key) AS skills
      FROM o LEFT JOIN g USING (lang, source) GROUP BY 1, 2
    """,
    "usable_skills": f"""
      WITH u AS ({_USES}),
      o AS (SELECT DISTINCT split_part(object_ref, '.', 1) AS s, substr(object_ref, instr(object_ref, '.') + 1) AS t
        FROM u WHERE use_kind = 'table')
      SELECT DISTINCT o.s AS schema_name, o.t AS table_name, u.provider, u.skill_key
      FROM o JOIN u ON u.use_kind = 'schema' AND u.object_ref = o.s
        OR u.use_kind = 'table' AND u.object_ref = o.s || '.' || o.t
    """,
    "skills_for_object": f"""
      SELECT DISTINCT provider, skill_key FROM ({_USES})
      WHERE (use_kind = 'schema' AND object_ref = 'en') OR (use_kind = 'table' AND object_ref = 'en.src1')
    """,
    "keyword_outcome": f"""
      SELECT w.keyword, count(s.key) AS hits
      FROM (VALUES ('the'), ('license'), ('src1/'), ('no_such_word_')) AS w(keyword)
      LEFT JOIN ({_SKILLS}) s ON lower(s.key || ' ' || s.content) LIKE '%' || w.keyword || '%'
      GROUP BY w.keyword
    """,
    "metric_search": """
      SELECT 'model_' || (c_custkey // 20) AS model_name, 'balance_' || c_custkey AS name, w.keyword
      FROM customer JOIN (VALUES ('balance_1'), ('customer#00000012')) AS w(keyword)
        ON lower('balance_' || c_custkey || ' Balance of ' || c_name || ' ') LIKE '%' || w.keyword || '%'
    """,
    "measure_search": f"""
      SELECT 'lookml' AS provider, 'part_' || p_partkey AS view_name, 'total_price' AS measure_name FROM part
      UNION ALL
      SELECT 'omni', view_name, 'total_price' FROM ({_OMNI}) WHERE lower('Total of ' || k) LIKE '%total of 1%'
    """,
    "notes_schemata": f"SELECT 's' || d AS note_id, lang AS schema_name, {_NOTE_TAIL} FROM ({_NOTES})",
    "notes_tables": f"""
      SELECT 't' || d AS note_id, table_catalog, lang AS table_schema, source AS table_name, {_NOTE_TAIL}
      FROM ({_NOTES})
    """,
    "notes_columns": f"""
      SELECT CASE WHEN d % 50 = 0 THEN 's' ELSE 'c' END || d AS note_id, table_catalog, lang AS table_schema,
        source AS table_name, 'text' AS column_name, {_NOTE_TAIL}
      FROM ({_NOTES})
    """,
    "notes_violations": f"""
      WITH n AS (
        SELECT d, d // 25 AS b, row_number() OVER (PARTITION BY d // 25 ORDER BY d) - 1 AS i FROM ({_NOTES})),
      s AS (SELECT n.*, x.section FROM n, (VALUES ('schema_notes'), ('table_notes'), ('column_notes')) AS x(section))
      SELECT 'notes/b' || b || '.yml' AS file_path, '/' || section || '/' || i || '/importance' AS path, 'range' AS rule
      FROM s WHERE d % 7 = 0
      UNION ALL
      SELECT 'notes/b' || b || '.yml', '/' || section || '/' || i || '/kind', 'required' FROM s WHERE d % 13 = 0
      UNION ALL
      SELECT 'notes/b' || b || '.yml', '/schema_notes/' || i || '/extra', 'unknown_field' FROM n WHERE d % 17 = 0
    """,
    "notes_valid": f"""
      SELECT x.section, count(*) AS n
      FROM ({_NOTES}), (VALUES ('schema_notes'), ('table_notes'), ('column_notes')) AS x(section)
      WHERE d % 7 <> 0 AND d % 13 <> 0 AND (x.section <> 'schema_notes' OR d % 17 <> 0)
      GROUP BY x.section
    """,
    "notes_repeated_ids": f"SELECT 's' || d AS note_id, 2::BIGINT AS uses FROM ({_NOTES}) WHERE d % 50 = 0",
    "context_schemata": _context("schema_name", "lang AS schema_name, 's' || d AS note_id"),
    "context_tables": _context(
        "table_catalog, table_schema, table_name",
        "lang AS table_schema, source AS table_name, 't' || d AS note_id",
    ),
    "context_columns": _context(
        "table_catalog, table_schema, table_name, column_name",
        "lang AS table_schema, source AS table_name, 'text' AS column_name, "
        "CASE WHEN d % 50 = 0 THEN 's' ELSE 'c' END || d AS note_id",
    ),
    "context_sql": f"""
      SELECT lang AS schema_name, count(*) AS schema_notes, max(importance) AS highest, count(DISTINCT source) AS tables,
        count(*) AS column_notes, max(importance) AS highest_of_columns
      FROM ({_NOTES}) GROUP BY lang
    """,
    "top_notes": f"""
      SELECT * FROM (
        SELECT lang AS table_schema, source AS table_name, 't' || d AS note_id,
          row_number() OVER (PARTITION BY lang, source
            ORDER BY importance DESC NULLS LAST, confidence DESC NULLS LAST, 't' || d) AS rank
        FROM ({_NOTES})) WHERE rank <= 3
    """,
    "picked_notes": f"""
      SELECT 't' || d AS note_id, source AS table_name, kind FROM ({_NOTES})
      WHERE kind = 'good' AND 'en' IN (lang, source)
    """,
    "enriched_tables": f"""
      WITH o AS (SELECT DISTINCT CASE WHEN doc_id % 2 = 1 THEN 'wh' END AS table_catalog, lang, source FROM documents),
      n AS (SELECT table_catalog, lang, source, count(*) AS c, max(importance) AS h FROM ({_NOTES}) GROUP BY ALL)
      SELECT o.table_catalog, o.lang AS table_schema, o.source AS table_name, n.c AS notes_on_count,
        n.h AS notes_on_highest_importance
      FROM o LEFT JOIN n ON n.table_catalog IS NOT DISTINCT FROM o.table_catalog
        AND n.lang = o.lang AND n.source = o.source
    """,
    "key_closure": f"""
      WITH RECURSIVE e AS ({_KEY_EDGES}),
      r AS (
        SELECT d AS node_id, 1::BIGINT AS depth FROM e WHERE u = 'region.0'
        UNION
        SELECT e.d, r.depth + 1 FROM e JOIN r ON e.u = r.node_id)
      SELECT node_id, min(depth) AS depth FROM r GROUP BY node_id
    """,
    "key_ancestors": f"""
      WITH RECURSIVE e AS ({_KEY_EDGES}),
      r AS (
        SELECT u AS node_id, 1::BIGINT AS depth FROM e WHERE d IN ('part.1', 'part.2')
        UNION
        SELECT e.u, r.depth + 1 FROM e JOIN r ON e.d = r.node_id)
      SELECT node_id, min(depth) AS depth FROM r GROUP BY node_id
    """,
    "view_model_match": _match(
        "lower(v.sql_table_name) LIKE '%' || lower(m.schema_name) || '.' || lower(m.name) || '%'"
    ),
    "view_model_match_literal": _match(
        "contains(lower(v.sql_table_name), lower(m.schema_name) || '.' || lower(m.name))"
    ),
    "store_insert": f"{_TARGET} UNION ALL {_SOURCE}",
    "store_upsert": f"{_TARGET} AND o_orderkey % 2 <> 0 UNION ALL {_SOURCE}",
    "store_upsert_last_wins": f"""
      WITH s AS (
        SELECT l_orderkey, l_partkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_returnflag DESC) AS rn
        FROM lineitem)
      SELECT * FROM ({_TARGET}) WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
      UNION ALL
      SELECT l_orderkey, l_partkey, l_returnflag, 0.0::DOUBLE FROM s WHERE rn = 1
    """,
    "store_delete": f"{_TARGET} AND o_orderkey % 11 <> 0",
    "store_reconcile": _SOURCE,
    "store_reconcile_changes": """
      WITH c AS (
        SELECT o_orderkey % 3 <> 0 AS old, o_orderkey % 2 = 0 OR o_orderkey % 4 = 1 AS new, o_orderkey % 2 = 0 AS bumped
        FROM orders)
      SELECT CASE WHEN NOT old THEN 'inserted' WHEN NOT new THEN 'deleted' WHEN bumped THEN 'updated'
        ELSE 'unchanged' END AS change, count(*) AS n
      FROM c WHERE old OR new GROUP BY 1
    """,
    "store_present_only": f"{_TARGET} AND o_orderkey % 2 = 0",
    "published_family": """
      SELECT 'lookml_view' AS table_name, count(*) AS n FROM part
      UNION ALL SELECT 'lookml_dimension', 4 * count(*) FROM part
      UNION ALL SELECT 'lookml_measure', 2 * count(*) FROM part
      UNION ALL SELECT 'lookml_explore', count(*) FROM part
      UNION ALL SELECT 'root', 11
    """,
    "published_skills": """
      SELECT 'acme' AS provider, count(*) AS skills, count(*) FILTER (source = 'src5') AS rewritten,
        3 * count(*) FILTER (doc_id % 4 = 1 AND source <> 'src5') AS uses FROM documents
      UNION ALL
      SELECT 'other', count(*), 0, 3 * count(*) FILTER (doc_id % 4 = 1) FROM documents WHERE source = 'src1'
    """,
    "semantic_pointers": """
      SELECT DISTINCT 'semantic_view/WH.S' || s_nationkey || '.' || s_name AS key FROM supplier
    """,
    "semantic_pointers_sql": """
      SELECT DISTINCT 'semantic_view/WH.S' || s_nationkey || '.' || s_name AS key, '# Semantic view' AS title
      FROM supplier
    """,
    "root_listing": """
      SELECT DISTINCT 'snowflake_semantic' AS provider, 'semantic_view/WH.S' || s_nationkey || '.' || s_name AS key
      FROM supplier
      UNION ALL SELECT 'dbt', x.key FROM (VALUES ('overview'), ('model'), ('column'), ('dependency')) AS x(key)
    """,
    "refreshed_stream": """
      SELECT 'part_' || p_partkey AS name, p_name || ' #' || p_partkey AS label,
        'shop.part_' || p_partkey AS sql_table_name FROM part
    """,
    "refreshed_files": """
      SELECT CASE WHEN p_partkey = 1 THEN 'extra_1' ELSE 'part_' || p_partkey END AS name,
        p_name || CASE WHEN p_partkey < 50 THEN ' no. ' ELSE ' #' END || p_partkey AS label, 'Use for ' || p_type AS ai_context
      FROM part WHERE p_partkey // 50 <> 1
      UNION ALL SELECT * FROM (VALUES ('changed', '1', NULL), ('deleted', '2', NULL), ('broken', '1', NULL)) AS c(name, label, ai_context)
    """,
    "repeated_keys": """
      SELECT l_orderkey, l_linenumber, count(*) AS uses FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
    "missing_values": """
      SELECT 'lookml_view' AS table_name, 'name' AS column_name, count(*) AS nulls FROM part WHERE p_partkey % 50 = 0
    """,
    "broken_references": f"""
      WITH e AS ({_EDGES}), m AS ({_DBT})
      SELECT 'dbt_dependency.upstream_id' AS rule, upstream_id AS reference, count(*) AS uses FROM e
      WHERE upstream_type = 'model' AND upstream_id NOT IN (SELECT unique_id FROM m) GROUP BY ALL
    """,
    "family_key_violations": """
      SELECT 'lookml_view' AS table_name, 'part_' || p_partkey AS key, 2::BIGINT AS uses FROM part
      UNION ALL
      SELECT 'lookml_dimension', 'part_' || p_partkey || '/' || x.f, 2 FROM part,
        (VALUES ('p_partkey'), ('price'), ('net_price'), ('created')) AS x(f)
      UNION ALL
      SELECT 'lookml_measure', 'part_' || p_partkey || '/' || x.f, 2 FROM part, (VALUES ('total_price'), ('n')) AS x(f)
      UNION ALL
      SELECT 'lookml_explore', CASE WHEN p_partkey % 3 = 0 THEN 'exp_' ELSE 'part_' END || p_partkey, 2 FROM part
    """,
    "table_counts": f"""
      SELECT 'dbt_model' AS table_name, count(*) AS n FROM ({_DBT})
      UNION ALL SELECT 'dbt_column', 3 * count(*) FROM ({_DBT})
      UNION ALL SELECT 'dbt_dependency', count(*) FROM ({_EDGES})
    """,
}
