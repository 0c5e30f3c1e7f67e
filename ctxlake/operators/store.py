"""Keyed maintenance of catalog tables kept as parquet folders.

Rows lie in hash buckets of the key. A change reads and rewrites only the buckets
its keys fall into, into new folders, and is published by creating one small
numbered marker that lists the folders of every bucket. Readers follow the highest
marker, so they see the old rows or the new rows and never a half-written table.
The marker is created without overwrite: of two writers that started from the same
version one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..runtime import scratch
from ..specs import ALL_TABLES, ROOT, SKILL_USE, TableSpec


# --- the row logic, usable on any frames ---


def last_write_wins(source: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """One row per key: the one with the highest ``sequence``.

    The rank filter is applied per task before the shuffle, so a key that repeats
    very often sends one row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(sequence).desc())
    return source.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: target rows whose key the source lacks, plus all source rows."""
    untouched = target.join(source.select(*keys), list(keys), "left_anti")
    return untouched.select(*target.columns).unionByName(source.select(*target.columns))


def without_keys(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(doomed.select(*keys), list(keys), "left_anti").select(*target.columns)


def present_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key occurs in the source."""
    return target.join(source.select(*keys), list(keys), "left_semi").select(*target.columns)


def change_counts(target: DataFrame, source: DataFrame, spec: TableSpec) -> DataFrame:
    """How many keys a reconcile inserts, updates, deletes and leaves alone: ``(change, n)``."""
    keys = list(spec.keys)
    # Hashes skip nulls, so each value comes with whether it is one: a value that moves to a neighbouring null column is a change.
    # Scalars are hashed as they are (a timestamp to the microsecond), lists as JSON text with their nulls.
    nested = {f.name for f in spec.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))}
    value = lambda c: F.to_json(c, {"ignoreNullFields": "false"}) if c in nested else F.col(c)
    body = F.xxhash64(F.lit(0), *[x for c in spec.value_columns for x in (F.isnull(c), value(c))])
    old = target.select(*keys, body.alias("old"))
    new = source.select(*keys, body.alias("new"))
    change = (
        F.when(F.col("old").isNull(), F.lit("inserted"))
        .when(F.col("new").isNull(), F.lit("deleted"))
        .when(F.col("old") == F.col("new"), F.lit("unchanged"))
        .otherwise(F.lit("updated"))
    )
    return (
        old.join(new, keys, "full_outer")
        .groupBy(change.alias("change"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- published tables ---


Layout = dict[str, list[str]]


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, *parts: str) -> list[str]:
        folder, files = self._path(*parts), self._files()
        return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []

    def _markers(self, spec: TableSpec) -> list[int]:
        return sorted(int(n) for n in self._names(spec.name, "_published") if n.isdigit())

    def _layout(self, spec: TableSpec, version: int) -> Layout:
        """Folders per non-empty bucket."""
        if not version:
            return {}
        stream = self._files().open(self._path(spec.name, "_published", f"{version:012d}"))
        try:
            stored = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        if stored["buckets"] != spec.buckets:
            raise ValueError(f"table {spec.name} has {stored['buckets']} buckets, not {spec.buckets}")
        return stored["parts"]

    def version(self, spec: TableSpec) -> int:
        return max(self._markers(spec), default=0)

    def exists(self, spec: TableSpec) -> bool:
        return self.version(spec) > 0

    def _rows(self, spec: TableSpec, layout: Layout) -> DataFrame:
        base = f"{self.root}/{spec.name}"
        paths = [f"{base}/write={w}/part={p}" for p, writes in layout.items() for w in writes]
        if not paths:
            return self.spark.createDataFrame([], spec.schema)
        frame = self.spark.read.schema(spec.schema).option("basePath", base).parquet(*paths)
        return frame.select(*spec.columns)

    def read(self, spec: TableSpec, version: int | None = None) -> DataFrame:
        version = version or self.version(spec)
        if not version:
            raise LookupError(f"table {spec.name} does not exist")
        return self._rows(spec, self._layout(spec, version))

    def _write(self, spec: TableSpec, rows: DataFrame) -> Layout:
        """New folders for these rows; nothing refers to them yet."""
        name = uuid.uuid4().hex[:16]
        placed = spec.conform(rows).withColumn("part", spec.bucket)
        if spec.buckets > 1:
            # One file set per bucket; a bucket that is far too big is split by size.
            placed = placed.hint("rebalance", F.col("part"))
        placed.write.partitionBy("part").parquet(f"{self.root}/{spec.name}/write={name}")
        found = [n for n in self._names(spec.name, f"write={name}") if n.startswith("part=")]
        return {n.removeprefix("part="): [name] for n in found}

    def _publish(self, *changes: tuple[TableSpec, int, Layout]) -> None:
        """Make the given layouts current; each must follow the version it started from."""
        files = self._files()
        for spec, base, layout in changes:
            stream = files.create(self._path(spec.name, "_published", f"{base + 1:012d}"), False)
            stream.write(bytearray(json.dumps({"buckets": spec.buckets, "parts": layout}).encode()))
            stream.close()

    def _rewritten(
        self,
        spec: TableSpec,
        touched: DataFrame | None,
        change: Callable[[DataFrame], DataFrame],
    ) -> tuple[TableSpec, int, Layout]:
        """``change`` applied to the buckets of ``touched`` (all buckets when None)."""
        base = self.version(spec)
        layout = self._layout(spec, base)
        if touched is None or spec.buckets == 1:
            return spec, base, self._write(spec, change(self._rows(spec, layout)))
        parts = {str(r["part"]) for r in touched.select(spec.bucket.alias("part")).distinct().collect()}
        old = self._rows(spec, {p: w for p, w in layout.items() if p in parts})
        kept = {p: w for p, w in layout.items() if p not in parts}
        return spec, base, {**kept, **self._write(spec, change(old))}

    @contextmanager
    def _changes(self, spec: TableSpec, rows: DataFrame, sequence: str | None = None) -> Iterator[DataFrame]:
        """The change set, written once and with one row per key."""
        if not spec.keys:
            raise ValueError(f"table {spec.name} has no key")
        if sequence is not None:
            rows = last_write_wins(rows, spec.keys, sequence)
        with scratch(spec.conform(rows), "changes") as changes:
            if sequence is None and not changes.groupBy(*spec.keys).count().filter("count > 1").isEmpty():
                raise ValueError(f"repeated keys for {spec.name}; give a sequence column")
            yield changes

    def ensure(self, spec: TableSpec) -> None:
        if not self.exists(spec):
            self._publish((spec, 0, {}))

    def replace(self, spec: TableSpec, rows: DataFrame | None = None) -> None:
        """New content; without ``rows`` the table becomes empty."""
        base = self.version(spec)
        self._publish((spec, base, {} if rows is None else self._write(spec, rows)))

    def insert(self, spec: TableSpec, rows: DataFrame) -> None:
        """Append; keys are not checked and existing rows are not read."""
        base = self.version(spec)
        layout = self._layout(spec, base)
        for part, writes in self._write(spec, rows).items():
            layout[part] = [*layout.get(part, []), *writes]
        self._publish((spec, base, layout))

    def upsert(self, spec: TableSpec, rows: DataFrame, sequence: str | None = None) -> None:
        with self._changes(spec, rows, sequence) as changes:
            self._publish(self._rewritten(spec, changes, lambda old: merged(old, changes, spec.keys)))

    def delete(self, spec: TableSpec, key_columns: Sequence[str], rows: DataFrame) -> None:
        if not key_columns:
            raise ValueError("no key columns given")
        with scratch(rows.select(*key_columns).distinct(), "doomed") as doomed:
            if doomed.isEmpty():
                return
            known = doomed if set(spec.bucket_by) <= set(key_columns) else None
            self._publish(self._rewritten(spec, known, lambda old: without_keys(old, doomed, key_columns)))

    def reconcile(self, spec: TableSpec, rows: DataFrame, sequence: str | None = None) -> DataFrame:
        """Make the table equal to ``rows``; returns the change counts."""
        base = self.version(spec)
        before = self._rows(spec, self._layout(spec, base))
        with self._changes(spec, rows, sequence) as changes:
            layout = self._write(spec, changes)
        self._publish((spec, base, layout))
        return change_counts(before, self._rows(spec, layout), spec)

    def publish_family(self, registry: DataFrame, tables: Mapping[str, DataFrame]) -> None:
        """Replace a family and upsert its registry rows.

        All data is written before anything is published; the registry comes last.
        """
        family = [ALL_TABLES[name] for name in tables]
        with self._changes(ROOT, registry) as changes:
            written = [(spec, self.version(spec), self._write(spec, tables[spec.name])) for spec in family]
            roots = self._rewritten(ROOT, changes, lambda old: merged(old, changes, ROOT.keys))
            self._publish(*written, roots)

    def publish_skills(
        self, provider: str, roots: DataFrame, uses: DataFrame, *, prune: bool = False
    ) -> None:
        """Refresh all skills of one provider: its uses are replaced, others stay.

        Skills that disappeared keep their registry row unless ``prune`` is set.
        """
        use_rows = SKILL_USE.conform(uses).dropDuplicates(list(SKILL_USE.keys))
        gone = (F.col("provider") == provider) & F.col("key").startswith("skill/")
        with self._changes(ROOT, roots) as changes:

            def new_roots(old: DataFrame) -> DataFrame:
                return merged(old.filter(~gone) if prune else old, changes, ROOT.keys)

            def new_uses(old: DataFrame) -> DataFrame:
                return old.filter(F.col("provider") != provider).unionByName(use_rows)

            self._publish(
                self._rewritten(SKILL_USE, None, new_uses),
                self._rewritten(ROOT, None if prune else changes, new_roots),
            )

    def publish_skill_batch(self, roots: DataFrame, uses: DataFrame) -> None:
        """Upsert some skills: content by key, and for exactly these skills new uses."""
        use_rows = SKILL_USE.conform(uses).dropDuplicates(list(SKILL_USE.keys))
        with self._changes(ROOT, roots) as changes:
            touched = changes.select("provider", F.col("key").alias("skill_key"))

            def new_uses(old: DataFrame) -> DataFrame:
                return without_keys(old, touched, ("provider", "skill_key")).unionByName(use_rows)

            self._publish(
                self._rewritten(SKILL_USE, touched, new_uses),
                self._rewritten(ROOT, changes, lambda old: merged(old, changes, ROOT.keys)),
            )

    def create_views(self, prefix: str = "") -> list[str]:
        """A temporary view per published table."""
        names = []
        for spec in ALL_TABLES.values():
            if self.exists(spec):
                self.read(spec).createOrReplaceTempView(prefix + spec.name)
                names.append(prefix + spec.name)
        return names

    def expire(self, spec: TableSpec, keep: int = 2) -> int:
        """Remove all but the newest ``keep`` versions; returns how many went."""
        markers = self._markers(spec)
        old, kept = markers[:-keep], markers[-keep:]

        def folders(versions: list[int]) -> set[str]:
            return {w for v in versions for writes in self._layout(spec, v).values() for w in writes}

        unused = folders(old) - folders(kept)
        files = self._files()
        for version in old:
            files.delete(self._path(spec.name, "_published", f"{version:012d}"), False)
        for name in unused:
            files.delete(self._path(spec.name, f"write={name}"), True)
        return len(old)
