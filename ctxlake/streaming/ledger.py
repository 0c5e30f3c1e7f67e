"""Refresh of a folder whose files are added, edited, deleted and broken between runs.

A ledger holds path, length and modification time of every file taken in. A run compares it with a listing by a full outer join
and reads only the files that differ. Beside each catalog table lies what each file gave to it, so an edited or deleted file takes
back its rows: where another file gives the same key, that row comes forward again, and of several files the later path wins.

A file that cannot be read keeps what its last good version gave; the ledger has its error until the file changes. All
tables are written before any is published and the ledger is published last, so a run that failed in between is made good by the
next one, which finds the same files changed. A file edited within the resolution of the modification time to the same
length is not noticed. A file of length zero counts as absent: it gives nothing, and emptying a file takes its rows back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F

from ..operators import lookml, skills
from ..operators.store import Catalog, without_keys
from ..runtime import scratch, staged
from ..sources.lookml import parse_lookml
from ..sources.scan import documents_since, listing
from ..specs import ALL_TABLES, FILE_LEDGER, ROOT, SKILL_USE, SOURCE_FILE, TableSpec

# Documents to tables whose rows carry their file, and the files that could not be read: ``(file_path, message)``.
Parse = Callable[[DataFrame], tuple[Mapping[str, DataFrame], DataFrame]]


def file_changes(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """``(file_path, length, modified, error, change)``; change is new, changed, deleted or unchanged. A deleted file has no length."""
    old = ledger.select("file_path", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"), "error")
    change = (
        F.when(F.col("old_length").isNull(), "new")
        .when(F.col("length").isNull(), "deleted")
        .when((F.col("length") == F.col("old_length")) & (F.col("modified") == F.col("old_modified")), "unchanged")
        .otherwise("changed")
    )
    return listed.join(old, "file_path", "full_outer").select("file_path", "length", "modified", "error", change.alias("change"))


def winners(given: DataFrame, spec: TableSpec) -> DataFrame:
    """Of the rows that files give for a key, that of the last path."""
    last = Window.partitionBy(*spec.keys).orderBy(F.desc(SOURCE_FILE))
    return given.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").select(*spec.columns)


def _one_each(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """A file that gives a key twice gives one row, the same one in every run."""
    first = Window.partitionBy(*spec.keys).orderBy(*[F.desc(c) for c in spec.value_columns or spec.keys])
    return rows.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def _table_changes(catalog: Catalog, name: str, spec: TableSpec, rows: DataFrame, touched: DataFrame) -> list:
    """New layouts of a table and of what files give to it. ``touched(source_file)``: files whose earlier rows go."""
    by_file = replace(spec.by_file(), name=f"{name}_{spec.by_file().name}")
    keys = list(spec.keys)
    fresh = staged(_one_each(by_file.conform(rows), by_file), "given")
    known = catalog.read(by_file) if catalog.exists(by_file) else catalog.spark.createDataFrame([], by_file.schema)
    gone = known.join(touched, SOURCE_FILE, "left_semi").select(*keys)
    affected = staged(gone.unionByName(fresh.select(*keys)).distinct(), "affected")

    def given(old: DataFrame) -> DataFrame:
        return old.join(touched, SOURCE_FILE, "left_anti").select(*by_file.columns).unionByName(fresh)

    def current(old: DataFrame) -> DataFrame:
        left = given(known).join(affected, keys, "left_semi")
        return without_keys(old, affected, keys).unionByName(winners(left, spec))

    return [catalog._rewritten(by_file, affected, given), catalog._rewritten(spec, affected, current)]


def refresh_files(catalog: Catalog, base: str, suffix: str, parse: Parse, *, name: str) -> DataFrame:
    """Take in what changed below ``base`` since the last run under this ``name``; returns ``(file_path, change, error)`` of the changed files.

    Errors of files that have not changed since stay in the ledger, see ``rejected``.
    """
    ledger = replace(FILE_LEDGER, name=f"{name}_{FILE_LEDGER.name}")
    known = catalog.read(ledger) if catalog.exists(ledger) else catalog.spark.createDataFrame([], ledger.schema)
    found = staged(file_changes(listing(catalog.spark, base, suffix), known), "files")
    differing = found.filter("change <> 'unchanged'")
    if differing.isEmpty():
        return differing.select("file_path", "change", "error")
    wanted = staged(differing.filter("change <> 'deleted'").select("file_path", "modified"), "files")
    docs = catalog.spark.createDataFrame([], "file_path string, content string") if wanted.isEmpty() else documents_since(catalog.spark, base, suffix, wanted)
    with scratch(docs, "documents") as texts:
        tables, faults = parse(texts)
        bad = staged(faults.groupBy("file_path").agg(F.min("message").alias("message")), "faults")
        read = staged(texts.select("file_path"), "read")
        good = read.join(bad, "file_path", "left_anti")
        touched = staged(good.unionByName(differing.filter("change = 'deleted'").select("file_path")).withColumnRenamed("file_path", SOURCE_FILE), "touched")
        changes = []
        for table, rows in tables.items():
            changes += _table_changes(catalog, name, ALL_TABLES[table], rows.join(touched, SOURCE_FILE, "left_semi"), touched)
    kept = found.filter("change = 'unchanged'").select("file_path", "length", "modified", "error")
    # A file that went between listing and reading gets a length no file has, so that the next run sees it changed or deleted.
    length = F.when(F.col("was_read"), F.col("length")).otherwise(F.lit(-1)).alias("length")
    present = differing.filter("change <> 'deleted'").drop("error")
    seen = present.join(read.withColumn("was_read", F.lit(True)), "file_path", "left").join(bad, "file_path", "left").select("file_path", length, "modified", F.col("message").alias("error"))
    version = catalog.version(ledger)
    changes.append((ledger, version, catalog._write(ledger, kept.unionByName(seen))))
    catalog._publish(*changes)
    return differing.drop("error").join(bad, "file_path", "left").select("file_path", "change", F.col("message").alias("error"))


def rejected(catalog: Catalog, name: str) -> DataFrame:
    """Files whose present version could not be read: ``(file_path, error)``."""
    return catalog.read(replace(FILE_LEDGER, name=f"{name}_{FILE_LEDGER.name}")).filter("error IS NOT NULL").select("file_path", "error")


def lookml_files(docs: DataFrame) -> tuple[Mapping[str, DataFrame], DataFrame]:
    blocks = staged(parse_lookml(docs), "blocks")
    return lookml.family_by_file(blocks.filter("error IS NULL")), lookml.rejects(blocks)


def skill_files(provider: str) -> Parse:
    """A skill with a faulty declaration is published without uses, so no skill file is unreadable."""

    def parse(docs: DataFrame) -> tuple[Mapping[str, DataFrame], DataFrame]:
        path = F.col("file_path").alias(SOURCE_FILE)
        roots = docs.select(path, F.lit(provider).alias("provider"), skills.skill_key().alias("key"), "content")
        uses = skills.use_rows(staged(skills.declarations(docs), "skills"), provider)
        keyed = docs.select(path, skills.skill_key().alias("skill_key"))
        return {ROOT.name: roots, SKILL_USE.name: uses.join(keyed, "skill_key")}, docs.limit(0).select("file_path", F.lit("").alias("message"))

    return parse


def refresh_lookml_files(catalog: Catalog, base: str, suffix: str = ".lkml") -> DataFrame:
    return refresh_files(catalog, base, suffix, lookml_files, name="lookml")


def refresh_skill_files(catalog: Catalog, base: str, provider: str) -> DataFrame:
    """Uses and registry rows of edited and deleted skills of ``provider`` follow their files."""
    return refresh_files(catalog, base, ".md", skill_files(provider), name=f"skills_{provider}")
