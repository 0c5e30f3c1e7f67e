"""File scans, YAML and LookML parsing, manifests."""

import json
import time

import pyarrow as pa
import pytest
import yaml
from pyspark.sql import functions as F, types as T

from ctxlake.operators import lookml, manifest, omni, publish
from ctxlake.operators.store import Catalog
from ctxlake.sources import manifest as manifest_source
from ctxlake.sources.arrow import flat_map_documents
from ctxlake.sources.lookml import lookml_rows, parse_lookml
from ctxlake.sources.manifest import load_manifests, manifests_from_text, read_manifests
from ctxlake.sources.scan import text_documents
from ctxlake.sources.yamldoc import parse_yaml, read_json, rejects


def write(base, files):
    for name, content in files.items():
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(base)


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_scan_gives_relative_paths_whole_text_and_clean_line_ends(spark, tmp_path):
    base = write(
        tmp_path / "a b+c",
        {"x y/q+1.md": "one\r\ntwo\rthree\n", "z.md": b"a\xffb", "skip.txt": "no", "deep/er/m.md": ""},
    )
    found = dict(rows(text_documents(spark, base, ".md"), "file_path", "content"))
    assert found == {"x y/q+1.md": "one\ntwo\nthree\n", "z.md": "a�b", "deep/er/m.md": ""}


def test_scan_without_recursion_and_without_files(spark, tmp_path):
    base = write(tmp_path / "osi", {"a.osi.yaml": "version: 1", "sub/b.osi.yaml": "version: 2"})
    assert rows(text_documents(spark, base, ".osi.yaml", recursive=False), "file_path") == [("a.osi.yaml",)]
    with pytest.raises(FileNotFoundError):
        text_documents(spark, base, ".md")
    with pytest.raises(FileNotFoundError):
        text_documents(spark, str(tmp_path / "absent"), ".md")
    assert text_documents(spark, base, ".md", required=False).count() == 0


def test_manifest_rows(spark, tmp_path):
    nodes = {
        "model.p.a": {
            "resource_type": "model",
            "name": "a",
            "database": "db",
            "schema": "s",
            "description": None,
            "original_file_path": "models/a.sql",
            "config": {"materialized": "table", "meta": {"owner": "x"}},
            "meta": {"owner": "y"},
            "tags": ["t"],
            "columns": {"id": {"data_type": "int", "description": "key"}, "v": {}},
            "depends_on": {"nodes": ["source.p.raw.t", "nodot", "source.p.raw.t"]},
        },
        "model.p.b": {"resource_type": "model", "name": "b", "config": {"meta": {}}, "meta": {"k": [1]}},
        "test.p.c": {"resource_type": "test", "name": "c"},
    }
    base = write(tmp_path / "proj", {"target/manifest.json": json.dumps({"nodes": nodes}, indent=1)})
    found = manifest.model_nodes(load_manifests(spark, base))
    models = {r["unique_id"]: r for r in manifest.models(found).collect()}
    assert set(models) == {"model.p.a", "model.p.b"}
    assert models["model.p.a"]["description"] == "" and models["model.p.a"]["tags"] == ["t"]
    assert json.loads(models["model.p.a"]["meta"]) == {"owner": "x"}
    assert json.loads(models["model.p.b"]["meta"]) == {"k": [1]} and models["model.p.b"]["tags"] == []
    assert rows(manifest.columns(found), "column_name", "data_type", "description") == [
        ("id", "int", "key"),
        ("v", "", ""),
    ]
    assert rows(manifest.dependencies(found), "upstream_id", "upstream_type", "downstream_type") == [
        ("nodot", "unknown", "model"),
        ("source.p.raw.t", "source", "model"),
    ]


def test_manifest_missing_and_nameless(spark, docs, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        load_manifests(spark, str(tmp_path / "empty"))
    text = json.dumps({"nodes": {"model.x": {"resource_type": "model"}}})
    found = manifest.model_nodes(manifests_from_text(docs({"m": text})))
    assert manifest.models(found).count() == 0
    assert rows(manifest.unnamed_models(found), "unique_id") == [("model.x",)]


LOOKML = """
# view: ghost { it's "quoted" }
view: orders {
  sql_table_name: "wh".shop.orders ;;
  label: "Orders # all"
  description: "She said \\"hi\\" } ok"
  parameter: p { label: "hidden" type: string }
  dimension: id { primary_key: yes type: number sql: ${TABLE}.id ;; }
  dimension_group: made {
    type: time
    timeframes: [
      date, month
    ]
    sql: CASE WHEN ${TABLE}.made > '1' THEN 1
         ELSE 2 END ;;
  }
  measure: total {
    type: sum
    sql:
      ${amount}
    ;;
    filters: [status: "complete", kind: "x"]
    label: "Total
of all"
  }
  measure: n { type: count }
}
view: +orders { dimension: refined { type: string } }
explore: orders {
  label: "Own"
  join: people { from: persons label: "Other" }
}
explore: renamed { from: orders }
"""


def test_lookml_rows(docs):
    blocks = parse_lookml(docs({"m/a.view.lkml": LOOKML}))
    assert rows(lookml.views(blocks), "name", "sql_table_name", "label", "description", "file_path") == [
        ("orders", '"wh".shop.orders', "Orders # all", 'She said \\"hi\\" } ok', "m/a.view.lkml")
    ]
    assert rows(lookml.dimensions(blocks), "field_name", "field_kind", "type", "sql", "primary_key") == [
        ("id", "dimension", "number", "${TABLE}.id", True),
        ("made", "dimension_group", "time", "CASE WHEN ${TABLE}.made > '1' THEN 1\nELSE 2 END", False),
    ]
    measures = {r["measure_name"]: r for r in lookml.measures(blocks).collect()}
    assert measures["total"]["sql"] == "${amount}"
    assert measures["total"]["filters"] == 'status: "complete", kind: "x"'
    assert measures["n"]["type"] == "count" and measures["n"]["sql"] is None
    assert rows(lookml.explores(blocks), "name", "from_view") == [("orders", "orders"), ("renamed", "orders")]
    labels = dict(rows(lookml.explores(blocks).filter("label IS NOT NULL"), "name", "label"))
    assert labels == {"orders": "Own"}


def test_lookml_unterminated_block_rejects_the_file_only(docs):
    blocks = parse_lookml(docs({"bad.lkml": "view: a {\n dimension: b { type: x }\n", "ok.lkml": "view: c { }"}))
    assert rows(lookml.views(blocks), "name") == [("c",)]
    assert rows(lookml.rejects(blocks), "file_path") == [("bad.lkml",)]


OMNI_VIEW = """# Reference this view as finance__orders
schema: finance
table_name: ORDERS
label: 5
dimensions:
  id: {sql: '"ID"', format: ID, primary_key: true}
  odd: text
  late: {label: Late, primary_key: "false"}
measures:
  count: {aggregate_type: count}
"""
TOPIC = """base_view: v_a
label: Board
joins:
  v_b: {}
  v_c:
    v_d: {}
  v_e:
    v_c: {v_d: }
"""


def test_omni_view_names_and_fields(docs):
    files = {
        "s/one.view.yaml": OMNI_VIEW,
        "dir/plain.view.yaml": "schema: b",
        "top.view.yaml": "",
        "bad.view.yaml": "a: [1",
        "list.view.yaml": "- 1",
    }
    parsed = parse_yaml(docs(files))
    found = omni.view_documents(parsed)
    assert rows(omni.views(found), "view_name") == [("dir__plain",), ("finance__orders",), ("top",)]
    assert rows(omni.views(found).filter("label IS NOT NULL"), "label") == [("5",)]
    assert rows(omni.dimensions(found), "field_name", "primary_key") == [("id", True), ("late", False), ("odd", False)]
    assert rows(omni.measures(found), "measure_name", "aggregate_type") == [("count", "count")]
    assert rows(rejects(parsed), "file_path") == [("bad.view.yaml",), ("list.view.yaml",)]


def test_omni_topic_joins(docs):
    parsed = parse_yaml(docs({"Board: H2 (draft).topic.yaml": TOPIC, "b.topic.yaml": "joins: {}"}), tree="joins")
    found = omni.topic_documents(parsed)
    assert rows(omni.topics(found), "topic_name", "base_view") == [("Board: H2 (draft)", "v_a"), ("b", "")]
    assert rows(omni.topic_joins(found), "from_view", "to_view") == [
        ("v_a", "v_b"),
        ("v_a", "v_c"),
        ("v_a", "v_e"),
        ("v_c", "v_d"),
        ("v_e", "v_c"),
    ]


def test_yaml_dates_are_tagged_only_on_request(docs):
    files = {"a": "d: 2024-01-02\nk: {2: x}"}
    plain = parse_yaml(docs(files)).select(F.get_json_object("json", "$.d")).first()[0]
    tagged = parse_yaml(docs(files), tag_dates=True).select(F.get_json_object("json", "$.d")).first()[0]
    assert plain == "2024-01-02" and json.loads(tagged) == {"$date": "2024-01-02"}


def test_filter_blocks_of_a_measure():
    text = 'view: v { measure: m { type: count filters: { field: s value: "-x" } filters: { field: t value: ">1" } } measure: n { type: count filters: { field: s } } }'
    assert [r[4].get("filters") for r in lookml_rows("f", text) if r[1] == "measure"] == ['s: "-x", t: ">1"', "?"]


def test_corrupt_manifest_is_a_reject(spark, tmp_path):
    for name, text in (("a", '{"nodes": {"model.a": {"resource_type": "model", "name": "a"}}}'), ("b", '{"nodes": {"model.b": {"resour'), ("c", "{}")):
        (tmp_path / name / "target").mkdir(parents=True)
        (tmp_path / name / "target" / "manifest.json").write_text(text)
    found = read_manifests(spark, str(tmp_path))
    assert sorted(r["file_path"] for r in manifest_source.rejects(found).collect()) == ["b/target/manifest.json", "c/target/manifest.json"]
    catalog = Catalog(spark, str(tmp_path / "catalog"))
    with pytest.raises(ValueError, match="target/manifest.json"):
        publish.refresh_manifests(catalog, str(tmp_path))


class _Frame:
    """Stands for a DataFrame and hands out the task function."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_tasks_hold_one_document_and_send_small_batches():
    schema = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("content", T.StringType())])
    seen, packed = [], []

    def parse(path, content):
        seen.append(path)
        yield path, content

    docs = pa.RecordBatch.from_pydict({"file_path": [f"f{i}" for i in range(40)], "content": ["x" * 300_000] * 40})
    for batch in flat_map_documents(_Frame(), parse, schema)(iter([docs, docs.slice(0, 3)])):
        packed.append((len(seen), batch.num_rows, batch.nbytes))
    assert sum(rows for _, rows, _ in packed) == len(seen) == 43
    assert max(size for _, _, size in packed) < 2_000_000
    assert packed[0][0] == 4  # the first batch leaves before the fifth document is read


def test_json_is_read_as_yaml_reads_it():
    same = ['{"a": 1.0E10, "b": [1.5e-3, 2e5, -0], "": null}', '{"2024-01-01": "2024-01-01", "<<": {"n": "yes"}}',
            '{\n "a" : "x: # y",\n "a": {}}\n', '{"q": "\\u00e9\\t\\"", "é😀": true}']
    for text in same:
        assert json.dumps(read_json(text)) == json.dumps(yaml.safe_load(text)), text
    apart = ["a: 1", '{"a": "x y"}', '{"a": "\x7f"}', '{"a": "\\ud83d\\ude00"}', '{"a"\n: 1}', '{"a":\t1}', '{"a": NaN}',
             '{"%s": 1}' % ("k" * 1100), '{a: 1}', '{"a": 1']
    for text in apart:
        with pytest.raises(ValueError):
            read_json(text)


def test_json_documents_keep_their_rows_and_faults(spark, docs):
    found = parse_yaml(docs({"a": '{"d": 2024-01-02, "j": {"k": {}}}', "b": '{"j": {"k": {"l": ""}}}', "c": '{"j": "\x07"}'}), tree="j")
    read = {r["file_path"]: r for r in found.collect()}
    assert json.loads(read["a"]["json"]) == {"d": "2024-01-02", "j": {"k": {}}}
    assert read["b"]["key_paths"] == [["k"], ["k", "l"]]
    assert read["c"]["json"] is None and "control characters" in read["c"]["error"]


def test_blank_stretches_of_lookml_cost_no_square():
    start = time.process_time()
    rows = lookml_rows("f", "view: a {" + " " * 60_000 + "label: x }")
    assert rows == [("f", "view", None, "a", {"label": "x"}, None)]
    assert time.process_time() - start < 2
