"""One refresh per source: scan, parse once, flatten, check, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..runtime import scratch, staged
from ..specs import ALL_TABLES, ROOT
from ..sources import lookml as lookml_source
from ..sources.manifest import read_manifests, rejects
from ..sources.scan import text_documents
from ..sources.yamldoc import parse_yaml
from . import contract, lookml, manifest, notes, omni, osi, registry, skills
from .checks import row_counts
from .store import Catalog


def _publish(catalog: Catalog, provider: str, tables: dict[str, DataFrame]) -> DataFrame:
    catalog.publish_family(registry.root_entries(catalog.spark, provider), tables)
    return row_counts({name: catalog.read(ALL_TABLES[name]) for name in tables})


def refresh_manifests(catalog: Catalog, base: str) -> DataFrame:
    """A corrupt manifest, or a model without a name, fails the run before anything is written."""
    with scratch(read_manifests(catalog.spark, base), "manifests") as read:
        if read.isEmpty():
            raise FileNotFoundError(f"no compiled manifest found below {base}")
        contract.require_none(rejects(read).selectExpr("file_path", "'/' AS path", "message"), "manifest")
        nodes = manifest.model_nodes(read)
        contract.require_none(
            manifest.unnamed_models(nodes).selectExpr("file_path", "unique_id AS path", "message"), "manifest"
        )
        return _publish(catalog, "dbt", manifest.family(nodes))


def refresh_lookml(catalog: Catalog, base: str) -> DataFrame:
    parsed = lookml_source.parse_lookml(text_documents(catalog.spark, base, ".lkml"))
    with scratch(parsed, "lookml") as blocks:
        contract.require_none(lookml.rejects(blocks).selectExpr("file_path", "'/' AS path", "message"), "LookML")
        return _publish(catalog, "lookml", lookml.family(blocks))


def refresh_omni(catalog: Catalog, base: str) -> DataFrame:
    """Unreadable files are left out, as are files that are not mappings."""
    views = text_documents(catalog.spark, base, omni.VIEW_SUFFIX, required=False)
    topics = text_documents(catalog.spark, base, omni.TOPIC_SUFFIX, required=False)
    with (
        scratch(parse_yaml(views), "omni-views") as parsed_views,
        scratch(parse_yaml(topics, tree="joins"), "omni-topics") as parsed_topics,
    ):
        return _publish(catalog, "omni", omni.family(parsed_views, parsed_topics))


def refresh_osi(catalog: Catalog, base: str) -> DataFrame:
    """One invalid document fails the run before anything is written."""
    docs = text_documents(catalog.spark, base, ".osi.yaml", recursive=False)
    with scratch(parse_yaml(docs), "osi") as parsed:
        contract.require_none(contract.osi_violations(parsed), "OSI document")
        return _publish(catalog, "osi", osi.family(osi.model_rows(parsed)))


def refresh_skills(catalog: Catalog, base: str, provider: str, *, prune: bool = False) -> DataFrame:
    """Publishes all skills of a folder; returns the warnings."""
    docs = text_documents(catalog.spark, base, ".md")
    declared = staged(skills.declarations(docs), "skills")
    roots = skills.root_rows(docs, provider).unionByName(registry.root_entries(catalog.spark, "skills"))
    catalog.publish_skills(provider, roots, skills.use_rows(declared, provider), prune=prune)
    return skills.warnings(declared)


def publish_skills(catalog: Catalog, docs: DataFrame, provider: str) -> DataFrame:
    """Upserts just the given skills; returns the warnings."""
    declared = staged(skills.declarations(docs), "skills")
    roots = skills.root_rows(docs, provider).unionByName(registry.root_entries(catalog.spark, "skills"))
    catalog.publish_skill_batch(roots, skills.use_rows(declared, provider))
    return skills.warnings(declared)


def publish_semantic_views(catalog: Catalog, names) -> int:
    pointers = registry.pointer_rows(registry.semantic_view_names(names, catalog.spark))
    catalog.upsert(
        ROOT, pointers.unionByName(registry.root_entries(catalog.spark, registry.POINTER_PROVIDER))
    )
    return pointers.count()


def refresh_notes(catalog: Catalog, base: str, suffix: str = ".yml") -> DataFrame:
    docs = text_documents(catalog.spark, base, suffix)
    with scratch(parse_yaml(docs, tag_dates=True), "notes") as parsed:
        contract.require_none(notes.violations(parsed), "notes")
        return _publish(catalog, "notes_on", notes.family(notes.note_rows(parsed)))
