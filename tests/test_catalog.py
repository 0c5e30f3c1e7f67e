"""Table maintenance, refresh runs and streaming."""

import json

import pytest
from pyspark.sql import types as T

from ctxlake.operators import publish, registry
from ctxlake.operators.store import Catalog, change_counts, last_write_wins
from ctxlake.runtime import shared_root
from ctxlake.specs import ALL_TABLES, DBT_MODEL, LOOKML_DIMENSION, LOOKML_VIEW, ROOT, SKILL_USE, TableSpec
from ctxlake.streaming import ledger
from ctxlake.streaming.refresh import document_stream, refresh_skills_stream

THING = TableSpec(
    "thing",
    T.StructType(
        [
            T.StructField("k", T.LongType(), False),
            T.StructField("v", T.StringType()),
            T.StructField("tags", T.ArrayType(T.StringType())),
        ]
    ),
    ("k",),
    ("k",),
)


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, str(tmp_path / "catalog"))


def things(spark, *pairs):
    return spark.createDataFrame([(k, v, [v]) for k, v in pairs], THING.schema)


def content(catalog, spec=THING):
    return sorted((r["k"], r["v"]) for r in catalog.read(spec).collect())


@pytest.mark.parametrize("buckets", [1, 4])
def test_maintenance(spark, catalog, buckets):
    spec = THING.with_buckets(buckets)
    with pytest.raises(LookupError):
        catalog.read(spec)
    catalog.ensure(spec)
    catalog.ensure(spec)
    assert content(catalog, spec) == [] and catalog.version(spec) == 1
    catalog.insert(spec, things(spark, (1, "a"), (2, "b"), (3, "c")))
    catalog.upsert(spec, things(spark, (2, "B"), (4, "d")))
    once = content(catalog, spec)
    assert once == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    catalog.upsert(spec, things(spark, (2, "B"), (4, "d")))
    assert content(catalog, spec) == once
    catalog.delete(spec, ["k"], things(spark, (1, "x"), (9, "x")))
    assert content(catalog, spec) == [(2, "B"), (3, "c"), (4, "d")]
    catalog.delete(spec, ["v"], things(spark, (0, "c")))
    assert content(catalog, spec) == [(2, "B"), (4, "d")]
    catalog.insert(spec, things(spark, (4, "again")))
    assert content(catalog, spec) == [(2, "B"), (4, "again"), (4, "d")]
    counts = catalog.reconcile(spec, things(spark, (2, "B"), (5, "e")))
    assert content(catalog, spec) == [(2, "B"), (5, "e")]
    assert {r["change"] for r in counts.collect()} == {"unchanged", "inserted", "deleted"}
    catalog.reconcile(spec, things(spark))
    assert content(catalog, spec) == []
    catalog.replace(spec, things(spark, (7, "z")))
    catalog.replace(spec)
    assert content(catalog, spec) == []


def test_an_upsert_rewrites_only_touched_buckets(spark, catalog):
    spec = THING.with_buckets(16)
    catalog.replace(spec, things(spark, *[(i, "v") for i in range(200)]))
    before = catalog._layout(spec, catalog.version(spec))
    catalog.upsert(spec, things(spark, (5, "new")))
    after = catalog._layout(spec, catalog.version(spec))
    assert sum(before[p] != after[p] for p in before) == 1
    assert len(content(catalog, spec)) == 200 and (5, "new") in content(catalog, spec)
    with pytest.raises(ValueError, match="buckets"):
        catalog.read(THING)


def test_wrong_calls(spark, catalog):
    with pytest.raises(ValueError, match="repeated"):
        catalog.upsert(THING, things(spark, (1, "a"), (1, "b")))
    with pytest.raises(ValueError):
        catalog.delete(THING, [], things(spark, (1, "a")))
    nokey = TableSpec("nokey", THING.schema, ())
    with pytest.raises(ValueError, match="no key"):
        catalog.upsert(nokey, things(spark, (1, "a")))


def test_last_write_wins(spark):
    frame = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 1)], "k long, v string, n int")
    assert sorted((r["k"], r["v"]) for r in last_write_wins(frame, ["k"], "n").collect()) == [(1, "b"), (2, "d")]


def test_readers_keep_their_version_and_old_ones_expire(spark, catalog):
    catalog.replace(THING, things(spark, (1, "a")))
    early = catalog.read(THING)
    catalog.upsert(THING, things(spark, (1, "b"), (2, "c")))
    catalog.insert(THING, things(spark, (3, "d")))
    assert [r["v"] for r in early.collect()] == ["a"]
    assert catalog.expire(THING, keep=1) == 2
    assert content(catalog) == [(1, "b"), (2, "c"), (3, "d")]


def test_two_writers_from_one_version(spark, catalog):
    catalog.replace(THING, things(spark, (1, "a")))
    base = catalog.version(THING)
    mine = catalog._write(THING, things(spark, (2, "b")))
    catalog.upsert(THING, things(spark, (3, "c")))
    with pytest.raises(Exception, match="exist"):
        catalog._publish((THING, base, mine))
    assert content(catalog) == [(1, "a"), (3, "c")]


def test_change_counts(spark):
    old, new = things(spark, (1, "a"), (2, "b"), (3, "c")), things(spark, (2, "b"), (3, "C"), (4, "d"), (5, "e"))
    counts = {r["change"]: r["n"] for r in change_counts(old, new, THING).collect()}
    assert counts == {"inserted": 2, "updated": 1, "unchanged": 1, "deleted": 1}


def write(base, files):
    for name, text in files.items():
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return str(base)


def test_refresh_runs(spark, catalog, tmp_path):
    model = {"resource_type": "model", "name": "a", "depends_on": {"nodes": ["source.x.y"]}}
    dbt = write(tmp_path / "dbt", {"target/manifest.json": json.dumps({"nodes": {"model.p.a": model}})})
    publish.refresh_manifests(catalog, dbt)
    lookml = write(tmp_path / "lookml", {"v/a.view.lkml": "view: a { measure: n { type: count } }\nexplore: a {}"})
    counts = {r["table_name"]: r["n"] for r in publish.refresh_lookml(catalog, lookml).collect()}
    assert counts == {"lookml_view": 1, "lookml_dimension": 0, "lookml_measure": 1, "lookml_explore": 1}
    omni = write(tmp_path / "omni", {"a.view.yaml": "schema: s", "t.topic.yaml": "base_view: a\njoins: {b: {}}"})
    publish.refresh_omni(catalog, omni)
    note = "schema_notes:\n- {note_id: a, schema_name: s, kind: k, content: c}"
    publish.refresh_notes(catalog, write(tmp_path / "notes", {"n.yml": note}))
    publish.publish_semantic_views(catalog, ["WH.A", " WH.A "])
    assert catalog.read(DBT_MODEL).first()["name"] == "a"
    assert catalog.read(ALL_TABLES["omni_topic_join"]).first()["to_view"] == "b"
    root = catalog.read(ROOT)
    providers = {r["provider"]: r["count"] for r in root.groupBy("provider").count().collect()}
    assert providers == {"dbt": 4, "lookml": 5, "omni": 6, "notes_on": 4, "snowflake_semantic": 2}
    assert registry.pointer_listing(root).first()["key"] == "semantic_view/WH.A"
    assert "x_lookml_view" in catalog.create_views("x_")
    assert spark.sql("SELECT count(*) AS n FROM x_root").first()["n"] == 21
    model["name"] = "renamed"
    (tmp_path / "dbt/target/manifest.json").write_text(json.dumps({"nodes": {"model.p.b": model}}))
    publish.refresh_manifests(catalog, dbt)
    assert [r["unique_id"] for r in catalog.read(DBT_MODEL).collect()] == ["model.p.b"]


def test_invalid_input_writes_nothing(catalog, tmp_path):
    bad = 'version: "0.2.0.dev0"\nsemantic_model:\n- name: m\n  datasets:\n  - name: d\n'
    base = write(tmp_path / "osi", {"bad.osi.yaml": bad, "ok.osi.yaml": bad + "    source: s\n"})
    with pytest.raises(ValueError, match="bad.osi.yaml at /semantic_model/0/datasets/0/source"):
        publish.refresh_osi(catalog, base)
    broken = write(tmp_path / "lookml", {"a.lkml": "view: a {"})
    with pytest.raises(ValueError, match="closing brace"):
        publish.refresh_lookml(catalog, broken)
    assert not any(catalog.exists(t) for t in ALL_TABLES.values())


def uses(catalog):
    return sorted(tuple(r) for r in catalog.read(SKILL_USE).collect())


def test_skill_publication(catalog, tmp_path, docs):
    head = "---\nuses:\n  schemas: [{}]\n---\n# x\n"
    base = write(tmp_path / "skills", {"a.md": head.format("A"), "b/c.md": head.format("C"), "bad.md": "---\nuses"})
    warned = publish.refresh_skills(catalog, base, "acme")
    assert [r["skill_key"] for r in warned.collect()] == ["skill/bad"]
    publish.publish_skills(catalog, docs({"a.md": head.format("O")}), "other")
    assert uses(catalog) == [
        ("acme", "skill/a", "schema", "A"),
        ("acme", "skill/b/c", "schema", "C"),
        ("other", "skill/a", "schema", "O"),
    ]
    publish.publish_skills(catalog, docs({"a.md": "# no uses any more"}), "acme")
    assert ("acme", "skill/a", "schema", "A") not in uses(catalog) and len(uses(catalog)) == 2
    (tmp_path / "skills/a.md").unlink()
    publish.refresh_skills(catalog, base, "acme")
    keys = {(r["provider"], r["key"]) for r in registry.skill_listing(catalog.read(ROOT)).collect()}
    assert ("acme", "skill/a") in keys and ("other", "skill/a") in keys
    publish.refresh_skills(catalog, base, "acme", prune=True)
    keys = {(r["provider"], r["key"]) for r in registry.skill_listing(catalog.read(ROOT)).collect()}
    assert ("acme", "skill/a") not in keys and ("other", "skill/a") in keys
    assert ("other", "skill/a", "schema", "O") in uses(catalog)


def test_streaming_refresh(spark, catalog, tmp_path):
    base, state = tmp_path / "drops", str(tmp_path / "state")
    head = "---\nuses:\n  schemas: [{}]\n---\n# {}\n"
    write(base, {"one/a.md": head.format("A", "first"), "one/b.md": "plain"})

    def run():
        query = refresh_skills_stream(document_stream(spark, str(base), ".md"), catalog, "acme", state)
        query.awaitTermination()

    run()
    version = catalog.version(ROOT)
    run()
    assert catalog.version(ROOT) == version
    write(base, {"two/c.md": head.format("C", "third")})
    run()
    assert {u[1] for u in uses(catalog)} == {"skill/one/a", "skill/two/c"}
    assert catalog.read(ROOT).filter("provider = 'acme'").count() == 3


def test_checkpoint_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_ledger_refresh(spark, catalog, tmp_path):
    base = tmp_path / "project"
    view = "view: {} {{ label: \"{}\" dimension: id {{ type: number sql: ${{TABLE}}.id ;; }} }}\n"
    write(base, {"a.lkml": view.format("v", "first") + view.format("w", "only"), "sub/b.lkml": view.format("v", "second"), "c.lkml": ""})

    def run():
        found = ledger.refresh_lookml_files(catalog, str(base)).collect()
        return {r["file_path"]: (r["change"], bool(r["error"])) for r in found}

    def labels():
        return {r["name"]: r["label"] for r in catalog.read(LOOKML_VIEW).collect()}

    assert run() == {p: ("new", False) for p in ("a.lkml", "sub/b.lkml")}
    assert labels() == {"v": "second", "w": "only"}
    version = catalog.version(LOOKML_VIEW)
    assert run() == {} and catalog.version(LOOKML_VIEW) == version

    # An edit that leaves out a view, and a broken file: its last good rows stay.
    write(base, {"a.lkml": view.format("v", "edited"), "sub/b.lkml": "view: v {"})
    assert run() == {"a.lkml": ("changed", False), "sub/b.lkml": ("changed", True)}
    assert labels() == {"v": "second"}
    assert {r["field_name"] for r in catalog.read(LOOKML_DIMENSION).collect()} == {"id"}
    assert [r["file_path"] for r in ledger.rejected(catalog, "lookml").collect()] == ["sub/b.lkml"]
    assert run() == {}

    # The later file goes: the row of the earlier one comes forward.
    (base / "sub/b.lkml").unlink()
    assert run() == {"sub/b.lkml": ("deleted", False)}
    assert labels() == {"v": "edited"} and ledger.rejected(catalog, "lookml").isEmpty()
    write(base, {"a.lkml": ""})
    assert run() == {"a.lkml": ("deleted", False)}
    assert labels() == {} and catalog.read(LOOKML_DIMENSION).isEmpty()


def test_ledger_refresh_of_skills(spark, catalog, tmp_path):
    base, other = tmp_path / "one", tmp_path / "two"
    head = "---\nuses:\n  schemas: [{}]\n---\n# {}\n"
    write(base, {"a.md": head.format("A", "a"), "b.md": head.format("B", "b")})
    write(other, {"a.md": head.format("O", "o")})
    ledger.refresh_skill_files(catalog, str(base), "acme")
    ledger.refresh_skill_files(catalog, str(other), "other")
    write(base, {"a.md": head.format("A2", "longer")})
    (base / "b.md").unlink()
    ledger.refresh_skill_files(catalog, str(base), "acme")
    assert {(u[0], u[1], u[3]) for u in uses(catalog)} == {("acme", "skill/a", "A2"), ("other", "skill/a", "O")}
    assert {(r["provider"], r["key"]) for r in catalog.read(ROOT).collect()} == {("acme", "skill/a"), ("other", "skill/a")}
