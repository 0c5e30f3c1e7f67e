"""OSI documents, skills, notes, registry and their checks."""

import json

import pytest
from pyspark.sql import functions as F

from ctxlake.operators import checks, context, contract, notes, osi, registry, search, skills
from ctxlake.sources.yamldoc import parse_yaml
from ctxlake.specs import ALL_TABLES, OSI_DATASET


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


OSI = """
version: "0.2.0.dev0"
semantic_model:
  - name: m
    ai_context: just text
    custom_extensions: [{vendor_name: DBT, data: '{"a": 1}'}]
    datasets:
      - name: d
        source: db.s.t
        primary_key: [a, b]
        unique_keys: [[a], [b, c]]
        ai_context: {synonyms: [x, y], note: null}
        fields:
          - name: f
            expression: {dialects: [{dialect: ANSI_SQL, expression: "a || ' ' || b"}]}
            dimension: {is_time: true}
          - name: g
            expression: {dialects: [{dialect: ANSI_SQL, expression: g}, {dialect: SNOWFLAKE, expression: G}]}
    relationships:
      - {name: r, from: d, to: d, from_columns: [a], to_columns: [b]}
    metrics:
      - name: total
        expression: {dialects: [{dialect: ANSI_SQL, expression: SUM(d.a)}]}
"""


def test_osi_tables(docs):
    parsed = parse_yaml(docs({"a.osi.yaml": OSI}))
    assert contract.osi_violations(parsed).count() == 0
    found = osi.family(osi.model_rows(parsed))
    model = found["osi_model"].first()
    assert (model["version"], model["description"], model["synonyms"]) == ("0.2.0.dev0", "", [])
    assert json.loads(model["ai_context"]) == "just text"
    assert model["custom_extensions"][0]["data"] == '{"a": 1}'
    dataset = found["osi_dataset"].first()
    assert dataset["primary_key"] == ["a", "b"] and dataset["unique_keys"] == [["a"], ["b", "c"]]
    assert dataset["synonyms"] == ["x", "y"]
    assert json.loads(dataset["ai_context"]) == {"synonyms": ["x", "y"], "note": None}
    fields = {r["name"]: r for r in found["osi_field"].collect()}
    assert fields["f"]["is_time_dimension"] is True and fields["g"]["is_time_dimension"] is False
    assert [e["dialect"] for e in fields["g"]["expressions"]] == ["ANSI_SQL", "SNOWFLAKE"]
    assert rows(found["osi_relationship"], "from_dataset", "from_columns", "to_columns") == [("d", ["a"], ["b"])]
    for name, frame in found.items():
        assert frame.columns == ALL_TABLES[name].columns


@pytest.mark.parametrize(
    "change, path, rule",
    [
        (("source: db.s.t", "origin: x"), "/semantic_model/0/datasets/0/source", "required"),
        (("source: db.s.t", "source: 5"), "/semantic_model/0/datasets/0/source", "type"),
        (('"0.2.0.dev0"', '"1"'), "/version", "enum"),
        (("from_columns: [a]", "from_columns: []"), "/semantic_model/0/relationships/0/from_columns", "min_items"),
        (("dialect: SNOWFLAKE", "dialect: ORACLE"), "/semantic_model/0/datasets/0/fields/1/expression/dialects/1/dialect", "enum"),
        (("is_time: true", "is_time: 1"), "/semantic_model/0/datasets/0/fields/0/dimension/is_time", "type"),
        (("is_time: true", "is_date: true"), "/semantic_model/0/datasets/0/fields/0/dimension/is_date", "unknown_field"),
        (("ai_context: just text", "ai_context: [1]"), "/semantic_model/0/ai_context", "type"),
        (("synonyms: [x, y]", "synonyms: [x, 1]"), "/semantic_model/0/datasets/0/ai_context/synonyms/1", "type"),
        (("[[a], [b, c]]", "[[a], b]"), "/semantic_model/0/datasets/0/unique_keys/1", "type"),
        (("data: '{\"a\": 1}'", "data: null"), "/semantic_model/0/custom_extensions/0/data", "type"),
        (("  - name: m", "  - nom: m"), "/semantic_model/0/name", "required"),
        (("name: total", "name: null"), "/semantic_model/0/metrics/0/name", "type"),
    ],
)
def test_osi_contract(docs, change, path, rule):
    text = OSI.replace(*change)
    assert text != OSI
    found = rows(contract.osi_violations(parse_yaml(docs({"a": text}))), "path", "rule")
    assert (path, rule) in found


def test_osi_not_a_document(docs):
    parsed = parse_yaml(docs({"empty": "", "list": "- a", "bad": "a: [", "ok": OSI}))
    found = dict(rows(contract.osi_violations(parsed), "file_path", "rule"))
    assert found == {"empty": "type", "list": "type", "bad": "yaml"}
    with pytest.raises(ValueError, match="OSI document"):
        contract.require_none(contract.osi_violations(parsed), "OSI document")


SKILLS = {
    "plain.md": "# text\n---\n",
    "a/good.md": "---\nuses:\n  schemas: [S]\n  tables:\n    - S.T\n    - S.T\n---\n# body\n",
    "scalar.md": "---\nuses:\n  tables: S.T\n---\n",
    "unqualified.md": "---\nuses:\n  schemas: [S]\n  tables: [T]\n---\n",
    "open.md": "---\nuses:\n  schemas: [S]\n",
    "bad.md": "---\nuses: [\n---\nx",
    "list.md": "---\n- a\n---\n",
    "extra.md": "---\nuses: {schemas: [S], views: [V]}\n---\n",
    "none.md": "---\nname: x\nuses:\n---\n",
    "nulls.md": "---\nuses: {schemas: null, tables: [S.T]}\n---\n",
    "empty.md": "---\n---\nbody",
    "blank.md": "---\nuses: {schemas: ['']}\n---\n",
}


def test_skill_uses_and_warnings(docs):
    found = skills.declarations(docs(SKILLS))
    assert rows(skills.use_rows(found, "acme"), "provider", "skill_key", "use_kind", "object_ref") == [
        ("acme", "skill/a/good", "schema", "S"),
        ("acme", "skill/a/good", "table", "S.T"),
        ("acme", "skill/nulls", "table", "S.T"),
    ]
    warned = {k: w for k, w in rows(skills.warnings(found), "skill_key", "warning")}
    assert set(warned) == {f"skill/{n}" for n in ("scalar", "unqualified", "open", "bad", "list", "extra", "blank")}
    assert "not closed" in warned["skill/open"] and "without schema" in warned["skill/unqualified"]


def test_skill_content_is_unchanged(docs):
    found = dict(rows(skills.root_rows(docs(SKILLS), "acme"), "key", "content"))
    assert found["skill/a/good"] == SKILLS["a/good.md"] and len(found) == len(SKILLS)


NOTES = """
schema_notes:
  - {note_id: s1, schema_name: legal, kind: rule, content: c, tags: [a], confidence: 0.9, importance: 1, created_at: 2025-11-20T08:30:00Z}
table_notes:
  - {note_id: t1, table_schema: z, table_name: t, kind: grain, content: c, created_at: "2025-11-21 10:00:00", title: null}
"""


def test_notes_rows(docs):
    parsed = parse_yaml(docs({"n.yml": NOTES}), tag_dates=True)
    assert notes.violations(parsed).count() == 0
    found = notes.family(notes.note_rows(parsed))
    note = found["notes_on_schemata"].first()
    assert (note["confidence"], note["importance"], note["tags"]) == (0.9, 1.0, ["a"])
    assert str(note["created_at"]) == "2025-11-20 08:30:00"
    assert str(found["notes_on_tables"].first()["created_at"]) == "2025-11-21 10:00:00"
    assert found["notes_on_columns"].count() == 0


@pytest.mark.parametrize(
    "change, path, rule",
    [
        (("confidence: 0.9", "confidence: 2.0"), "/schema_notes/0/confidence", "range"),
        (("confidence: 0.9", "confidence: true"), "/schema_notes/0/confidence", "type"),
        (("tags: [a]", "tags: [1]"), "/schema_notes/0/tags/0", "type"),
        (("tags: [a]", "tags: ['']"), "/schema_notes/0/tags/0", "required"),
        (("kind: rule", "kind: ''"), "/schema_notes/0/kind", "required"),
        (("kind: rule, ", ""), "/schema_notes/0/kind", "required"),
        (("schema_name: legal", "schema: legal"), "/schema_notes/0/schema", "unknown_field"),
        (("title: null", "title: 2024-01-01"), "/table_notes/0/title", "type"),
        (('"2025-11-21 10:00:00"', "soon"), "/table_notes/0/created_at", "timestamp"),
        (('"2025-11-21 10:00:00"', "5"), "/table_notes/0/created_at", "type"),
        (("table_notes:\n  -", "table_notes:\n   "), "/table_notes", "type"),
        (("table_notes:", "other_notes:"), "/other_notes", "unknown_field"),
    ],
)
def test_notes_contract(docs, change, path, rule):
    text = NOTES.replace(*change)
    assert text != NOTES
    parsed = parse_yaml(docs({"n.yml": text}), tag_dates=True)
    assert (path, rule) in rows(notes.contract_violations(parsed), "path", "rule")


def test_note_ids_are_unique_across_sections_and_files(docs):
    parsed = parse_yaml(docs({"a.yml": NOTES, "b.yml": NOTES.replace("t1", "s1")}), tag_dates=True)
    assert rows(notes.duplicate_ids(parsed), "note_id", "uses") == [("s1", 3)]
    assert ("s1", "duplicate") in rows(notes.violations(parsed), "path", "rule")


def test_quarantine_keeps_other_notes(docs):
    parsed = parse_yaml(docs({"a.yml": NOTES.replace("confidence: 0.9", "confidence: 3")}), tag_dates=True)
    assert rows(notes.valid_rows(parsed), "section") == [("table_notes",)]


def test_context_holds_every_note_once(spark, docs):
    body = "\n".join(
        f"  - {{note_id: n{i}, table_schema: {'hot' if i % 3 else 's' + str(i)}, table_name: t, kind: k, "
        f"content: c, importance: {(i % 10) / 10}}}"
        for i in range(300)
    )
    parsed = parse_yaml(docs({"n.yml": "table_notes:\n" + body}), tag_dates=True)
    table = notes.section_notes(notes.note_rows(parsed), "table_notes")
    keys = context.OBJECT_KEYS["notes_on_tables"]
    every = context.context(table, keys).collect()
    ids = [r["note_id"] for r in every]
    assert sorted(ids) == sorted(r["note_id"] for r in table.collect())
    hot = [r for r in every if r["table_schema"] == "hot"]
    assert {r["notes_on_count"] for r in hot} == {len(hot)}
    top = [r for r in context.top_context(table, keys, 2).collect() if r["table_schema"] == "hot"]
    assert len(top) == 1 and len(top[0]["notes_on_notes"]) == 2 and top[0]["notes_on_count"] == len(hot)
    first = top[0]["notes_on_notes"][0].asDict()
    assert set(first) == set(context.NOTE_FIELDS) and first["author"] is None
    top = context.top_notes(table, ["table_schema"], 2).filter("table_schema = 'hot'").collect()
    assert [r["importance"] for r in top] == [0.9, 0.9]


def test_registry_and_pointers(spark):
    assert rows(registry.root_entries(spark, "skills"), "key") == [("overview",), ("root-convention",), ("skill_use",)]
    with pytest.raises(ValueError):
        registry.root_entries(spark, "nobody")
    names = registry.semantic_view_names([" a.b ", "a.b", "c\t"], spark)
    assert rows(names, "name") == [("a.b",), ("c",)]
    assert rows(registry.pointer_rows(names), "key") == [("semantic_view/a.b",), ("semantic_view/c",)]
    for wrong in ([], ["a", "  "]):
        with pytest.raises(ValueError):
            registry.semantic_view_names(spark.createDataFrame([(w,) for w in wrong], "name string"))


def test_table_checks(spark, docs):
    found = osi.family(osi.model_rows(parse_yaml(docs({"a": OSI, "b": OSI}))))
    assert rows(checks.key_violations({"osi_model": found["osi_model"]}), "key", "uses") == [("m", 2)]
    bad = found["osi_relationship"].selectExpr("* EXCEPT (to_dataset)", "'nowhere' AS to_dataset")
    broken = checks.reference_violations({**found, "osi_relationship": bad})
    assert set(rows(broken, "rule", "reference")) == {("osi_relationship.to_dataset", "m/nowhere")}
    nulls = found["osi_dataset"].selectExpr("* EXCEPT (source)", "CAST(NULL AS STRING) AS source")
    assert rows(checks.missing_values(nulls, OSI_DATASET), "column_name", "nulls") == [("source", 2)]
    assert dict(rows(checks.row_counts(found), "table_name", "n"))["osi_field"] == 4


def test_reference_rules_meet_in_one_shuffle(spark):
    dimension = spark.createDataFrame([("v",), ("w",), ("w",), (None,)], "view_name string")
    measure = spark.createDataFrame([("w",), ("v",)], "view_name string")
    view = spark.createDataFrame([("v",), ("v",), (None,)], "name string")
    broken = checks.reference_violations({"lookml_dimension": dimension, "lookml_measure": measure, "lookml_view": view})
    expected = [("lookml_dimension.view_name", "w", 2), ("lookml_measure.view_name", "w", 1)]
    assert sorted(rows(broken, "rule", "reference", "uses")) == expected
    plan = broken._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert checks.reference_violations({"lookml_dimension": dimension.limit(0), "lookml_view": view}).isEmpty()
    with pytest.raises(ValueError):
        checks.reference_violations({"lookml_dimension": dimension})


def test_granted_objects_and_failed_run(spark):
    uses = spark.createDataFrame([("table", "s.t"), ("table", "s.t"), ("table", "s.a.b"), ("schema", "s")], "use_kind string, object_ref string")
    assert sorted(rows(search.granted_objects(uses), "schema_name", "table_name")) == [("s", "a.b"), ("s", "t")]
    faults = spark.createDataFrame([(f"f{i}", "/", "bad") for i in range(5)], "file_path string, path string, message string")
    with pytest.raises(contract.ContractError, match="notes failed validation") as caught:
        contract.require_none(faults, "notes")
    assert caught.value.violations.count() == 5


def test_moved_value_is_an_update(spark):
    """A text that moves to a neighbouring null column changes the row."""
    from ctxlake.operators.store import change_counts
    from ctxlake.specs import LOOKML_VIEW

    def rows(**values):
        return spark.createDataFrame([tuple(values.get(c, "k" if c in LOOKML_VIEW.keys else None) for c in LOOKML_VIEW.columns)], ", ".join(f"`{c}` string" for c in LOOKML_VIEW.columns))

    a, b = LOOKML_VIEW.value_columns[:2]
    assert [r["change"] for r in change_counts(rows(**{a: "x"}), rows(**{b: "x"}), LOOKML_VIEW).collect()] == ["updated"]


def test_patterns_that_begin_alike_meet_few_references(spark):
    """300 references and 300 patterns share all text around the dot; the rest tells them apart."""
    views = spark.range(300).selectExpr("concat('v', id) AS name", "concat('m.large_', 1000 + id, '_x') AS sql_table_name")
    odd = spark.createDataFrame([("short", "m", "large%"), ("none", "m", "large%ring"), ("tail", "m", "large%_x")], "unique_id string, schema_name string, name string")
    models = spark.range(300).selectExpr("concat('p', id) AS unique_id", "'m' AS schema_name", "concat('large%', 1000 + id, '%x') AS name")
    models = models.unionByName(odd).withColumn("description", F.lit(None).cast("string"))
    met = []
    plain = search._starred_matches

    def counted(candidates, starred):
        frame = plain(candidates, starred)
        met.append(frame.count())
        return frame

    search._starred_matches = counted
    try:
        found = search.match_views_to_models(views, models).groupBy("dbt_model_id").count().collect()
    finally:
        search._starred_matches = plain
    counts = {r[0]: r[1] for r in found}
    assert counts.pop("short") == counts.pop("tail") == 300 and "none" not in counts
    assert counts == {f"p{i}": 1 for i in range(300)}
    assert met[0] < 5_000  # 90,900 before
